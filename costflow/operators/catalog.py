"""DDL text to a column catalog, and the target schema made from it.

A column catalog is a DataFrame with one row per column, so one statement or
a folder with thousands of them goes through the same expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costflow.sqltext import one_row

# Bare first words that open a constraint, not a column.
CONSTRAINT_WORDS = ("CONSTRAINT", "PRIMARY", "FOREIGN", "KEY", "INDEX", "UNIQUE", "CHECK")

# Quoted names, a doubled quote being one inside them, survive as group 1; comments and string literals are blanked.
_NOISE = r"""("(?:[^"]|"")*+")|'[^']*+(?:''[^']*+)*+'|--[^\n]*+|/\*[\s\S]*?\*/"""
_PARENTHESES = r"\((?:[^()]++|\((?:[^()]++|\([^()]*+\))*+\))*+\)"
_CLUSTER_BY = r"(?i)\bcluster\s+by\s*" + _PARENTHESES
_TABLE_NAME = r"(?i)\bTABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?((?:\"[^\"]*\"|[^\s(\"])+)"
_BODY = r'(?is)\bTABLE\b(?:"[^"]*+"|[^("])*+\((.*)\)'
_NUMBER = r"^(NUMBER|DECIMAL|NUMERIC)\(0*(\d+)(?:,\s*0*(\d+))?\)"
# A constraint word opens a constraint only before a parenthesis, KEY or a name and another such word.
_WORDS = "|".join(CONSTRAINT_WORDS)
_CONSTRAINT = rf"(?i)^\s*({_WORDS})\s*(\(|KEY\b|(\w+|\"[^\"]+\")\s*(\((?!\s*\d)|({_WORDS})\b))"
# Texts with every quote closed, with parentheses to a depth of three outside of quotes, and the parts between their commas.
_QUOTED = '"[^"]*+"'
_NESTED = rf"\((?:{_QUOTED}|[^\"()]++)*+\)"
for _ in range(2):
    _NESTED = rf"\((?:{_QUOTED}|[^\"()]++|{_NESTED})*+\)"
_PLAIN = rf"^(?:{_QUOTED}|[^\"()]++|{_NESTED})*+\z"
_PART = rf"((?:{_QUOTED}|[^,\"()]++|{_NESTED})*+)(?:,|\z)"
_COLUMN = r'^\s*(?:"((?:[^"]|"")+)"|(\w+))\s+([\w(),\s]*[\w(),])'


def parse_ddl(statements: DataFrame, text: str = "value") -> DataFrame:
    """Split CREATE TABLE texts into `(…, table_name, ordinal, name, type_text)`.

    Columns of `statements` other than the text are kept. The type text holds
    whatever follows the name, such as `NUMBER(38,0) NOT NULL`. `ordinal` counts
    the column items from 1. A text that is no CREATE TABLE gives no rows.
    """
    kept = [F.col(c) for c in statements.columns if c != text]
    clean = F.regexp_replace(F.regexp_replace(F.col(text), _NOISE, "$1"), _CLUSTER_BY, " ")
    items = (
        statements.select(*kept, clean.alias("_ddl"))
        .select(
            *kept,
            F.regexp_extract("_ddl", _TABLE_NAME, 1).alias("table_name"),
            F.regexp_extract("_ddl", _BODY, 1).alias("_body"),
        )
        .select(*kept, "table_name", _items(F.col("_body")).alias("_items"))
        # The outer form, as the inner one would parse twice to skip empty lists;
        # the filter below drops those.
        .select(*kept, "table_name", F.posexplode_outer("_items").alias("_pos", "_item"))
    )
    matched = items.where(F.col("_item").rlike(_COLUMN) & ~F.col("_item").rlike(_CONSTRAINT))
    quoted = F.regexp_extract("_item", _COLUMN, 1)
    return matched.select(
        *kept,
        "table_name",
        (F.col("_pos") + 1).alias("ordinal"),
        F.when(quoted != "", F.replace(quoted, F.lit('""'), F.lit('"'))).otherwise(F.regexp_extract("_item", _COLUMN, 2)).alias("name"),
        F.regexp_extract("_item", _COLUMN, 3).alias("type_text"),
    )


def _items(body: Column) -> Column:
    """The parts between commas outside quotes and parentheses, at any depth.

    One search finds them; an empty part may follow. Texts that `_PLAIN` leaves out are
    put together from the pieces between any commas, at several searches a piece.
    """
    return F.when(body.rlike(_PLAIN), F.regexp_extract_all(body, F.lit(_PART), F.lit(1))).otherwise(_gathered(body))


def _gathered(body: Column) -> Column:
    def complete(text: Column) -> Column:
        bare = F.regexp_replace(text, r'"[^"]*+"', "")
        count = lambda char: F.length(bare) - F.length(F.replace(bare, F.lit(char), F.lit("")))
        return ~bare.contains('"') & (count("(") == count(")"))

    def step(state: Column, part: Column) -> Column:
        text = F.concat_ws(",", state["open"], part)
        done = F.struct(F.concat(state["items"], F.array(text)).alias("items"), F.lit(None).cast("string").alias("open"))
        more = F.struct(state["items"].alias("items"), text.alias("open"))
        return F.when(complete(text), done).otherwise(more)

    start = F.struct(F.array().cast("array<string>").alias("items"), F.lit(None).cast("string").alias("open"))
    return F.aggregate(
        F.split(body, ","),
        start,
        step,
        lambda s: F.when(s["open"].isNull(), s["items"]).otherwise(F.concat(s["items"], F.array(s["open"]))),
    )


def map_types(catalog: DataFrame, type_text: str = "type_text") -> DataFrame:
    """Add `spark_type` and `recognized`; an unknown type becomes a string.

    All whole numbers without precision widen to bigint, lengths and time zones
    are dropped, NUMBER without scale narrows by precision, DECIMAL and NUMERIC
    do not narrow.
    """
    # Parts that several rules use get a column each and are worked out once.
    upper = F.upper(F.trim(F.translate(F.col(type_text), "\t\r\n\f\v", "     ")))
    parts = catalog.select("*", upper.alias("_type")).select(
        "*",
        F.regexp_extract("_type", _NUMBER, 1).alias("_base"),
        F.regexp_extract("_type", _NUMBER, 2).alias("_precision"),
        F.regexp_extract("_type", _NUMBER, 3).alias("_scale"),
    ).withColumns(
        # Only digits get here; more of them than an int holds are over 38 anyway.
        # No try_cast, as that raises and catches an exception for each empty text.
        {"_precision": _clamped("_precision"), "_scale": F.coalesce(_clamped("_scale"), F.lit(0))}
    )
    t, base, precision, scale = (F.col(c) for c in ("_type", "_base", "_precision", "_scale"))
    decimal = F.format_string(
        "decimal(%d,%d)", F.least(precision, F.lit(38)), F.least(scale, F.lit(38))
    )
    mapped = (
        F.when(t.rlike(r"^(FLOAT|DOUBLE)|^REAL$"), "double")
        .when(t.isin("INTEGER", "INT", "BIGINT", "SMALLINT", "TINYINT"), "bigint")
        .when(t.rlike(r"^(VARCHAR|STRING|CHAR)|^TEXT$"), "string")
        .when(t == "BOOLEAN", "boolean")
        .when(t == "DATE", "date")
        .when(t.startswith("TIMESTAMP"), "timestamp_ntz")
        .when((base == "NUMBER") & (scale == 0) & (precision <= 9), "int")
        .when((base == "NUMBER") & (scale == 0) & (precision <= 18), "bigint")
        .when(base != "", decimal)
        .when(t == "NUMBER", "bigint")
    )
    return parts.select(*catalog.columns, mapped.alias("_mapped")).select(
        *catalog.columns,
        F.coalesce("_mapped", F.lit("string")).alias("spark_type"),
        F.col("_mapped").isNotNull().alias("recognized"),
    )


def _clamped(digits: str) -> Column:
    text = F.col(digits)
    return F.when(text != "", F.when(F.length(text) > 2, F.lit(38)).otherwise(text.cast("int")))


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type_text: str
    spark_type: str
    recognized: bool = True


@dataclass(frozen=True)
class TargetSchema:
    """The typed columns a table should have, in DDL order."""

    columns: tuple[TargetColumn, ...]

    def types(self) -> dict[str, T.DataType]:
        """Lower-case name to Spark type; the last of equal names counts."""
        return {c.name.lower(): _spark_type(c.spark_type) for c in self.columns}

    def unrecognized(self) -> list[TargetColumn]:
        return [c for c in self.columns if not c.recognized]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.types().items()])

    @classmethod
    def of(cls, columns: Sequence[tuple[str, str]]) -> TargetSchema:
        """From (name, Spark type name) pairs."""
        return cls(tuple(TargetColumn(n, t, t) for n, t in columns))


@cache
def _spark_type(name: str) -> T.DataType:
    return T.DataType.fromDDL(name)


def target_from_catalog(catalog: DataFrame) -> TargetSchema:
    """Bring the catalog of one table to the driver as a `TargetSchema`.

    That there is one table only is made sure in Spark, before any row moves.
    """
    tables = ["table_name", *(c for c in ("statement",) if c in catalog.columns)]
    found = catalog.select(*tables).distinct().limit(2).count()
    if not found:
        raise ValueError("no column list found in the DDL")
    if found > 1:
        raise ValueError("the DDL describes more than one table")
    rows = map_types(catalog).select("ordinal", "name", "type_text", "spark_type", "recognized").collect()
    return TargetSchema(tuple(TargetColumn(*row[1:5]) for row in sorted(rows)))


def target_from_text(spark: SparkSession, ddl: str) -> TargetSchema:
    return target_from_catalog(parse_ddl(one_row(spark, value=("string", ddl))))
