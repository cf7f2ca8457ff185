"""Text scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costflow.operators.catalog import TargetSchema, parse_ddl, target_from_catalog

_STATEMENT = r"""(?:"[^"]*+"|'[^']*+'|--[^\n]*+|/\*[\s\S]*?\*/|[^;"'/-]++|[/-](?![/*-])|-(?!-)|/(?!\*))++"""

# Where a text can end: outside of everything, or inside a quote or comment, known by the character that opens it.
_STATES = ";\"'-/"
_OPENERS = {'"': '"', "'": "'", "-": "--", "/": "/*"}
_CLOSERS = {'"': '"', "'": "'", "-": "\n", "/": "*/"}
# From outside to the end of the text, or to the quote or comment that is open there.
_UNTIL_OPEN = r"""(?:"[^"]*+"|'[^']*+'|--[^\n]*+\n|/\*[\s\S]*?\*/|[^"'/-]++|-(?!-)|/(?!\*))*+(["'/-]?)"""
_UNTIL_CLOSED = {'"': r'[^"]*+"', "'": r"[^']*+'", "-": r"[^\n]*+\n", "/": r"[\s\S]*?\*/"}
# Pieces of a chunk, as a power of 2.
_CHUNK_BITS = 8


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per line."""
    return spark.read.text(path)


def scan_statements(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per SQL statement: files cut at each `;` outside quotes and comments.

    Only the beginning of a file tells whether a `;` is inside quotes, yet no file is
    read whole. Chunks of it are searched for the state that they end in, from every
    state they can begin in; the states are followed from chunk to chunk; then each
    chunk is cut by itself. Statements that lie across chunks are put together again.
    A quote or comment without an end is none; from the statement it is in to the end
    of the file, the text is one row until it is cut. A `;` that ends the file inside
    a line comment is not part of that comment.
    """
    chunks = _chunks(spark, path)
    states = _states(chunks.select("file", "block", "chunk", _ends("text").alias("ends")))
    # Both sides come from one scan; should they ever differ, the job fails and loses nothing.
    known = F.coalesce("first", F.raise_error(F.lit("a chunk of a file has no state")))
    chunks = chunks.join(states, ["file", "block", "chunk"], "left").withColumn("first", known)
    across = (F.col("first") != ";") | (F.col("last") != ";")
    return (
        _parts(chunks)
        .where(~F.col("goes_on") & ~F.col("is_open"))
        .select("value")
        .union(_joined(_parts(chunks.where(across)).where("goes_on OR is_open")))
        .where(F.trim("value", F.lit(" \t\r\n")) != "")
    )


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """`(file, block, chunk, text)`: some pieces between any `;` each, numbered in the order of the file."""
    pieces = spark.read.option("lineSep", ";").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    chunk = F.shiftright("id", _CHUNK_BITS).alias("chunk")
    return pieces.groupBy("file", "block", chunk).agg(_in_order("value", "id").alias("text"))


def _in_order(text: str, *order: str) -> Column:
    """The texts of a group with `;` between them."""
    rows = F.array_sort(F.collect_list(F.struct(*order, text)))
    return F.array_join(F.transform(rows, lambda row: row[text]), ";")


def _ends(text: str) -> Column:
    """The states that a text ends in, one letter for each of `_STATES` that it may begin in."""

    def end(state: str) -> Column:
        opened = F.regexp_extract(text, f"^{_UNTIL_CLOSED.get(state, '')}{_UNTIL_OPEN}", 1)
        found = F.when(opened == "", ";").otherwise(opened)
        if state == ";":
            return found
        return F.when(F.contains(F.col(text), F.lit(_CLOSERS[state])), found).otherwise(state)

    return F.concat(*(end(state) for state in _STATES))


def _states(ends: DataFrame) -> DataFrame:
    """`(file, block, chunk, first, last)`: the state that each chunk begins and ends in; files begin outside of all."""

    def follow(letters: Column, chunk: Column) -> Column:
        last = F.call_function("translate", F.right(letters, F.lit(1)), F.lit(_STATES), chunk["ends"])
        return F.concat(letters, last)

    per_file = ends.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "chunk", "ends"))).alias("at"))
    letters = per_file.withColumn("letters", F.split(F.aggregate("at", F.lit(";"), follow), ""))
    pairs = F.arrays_zip("at", F.slice("letters", 1, F.size("at")).alias("first"), F.slice("letters", 2, F.size("at")).alias("last"))
    return letters.select("file", F.explode(pairs).alias("_")).select("file", "_.at.block", "_.at.chunk", "_.first", "_.last")


def _parts(chunks: DataFrame) -> DataFrame:
    """The statements of chunks, without what lies in the chunk before (`goes_on`) or after (`is_open`).

    The quote or comment that a chunk begins or ends in is opened or closed for the cut.
    """
    opener, closer = _marks("first", _OPENERS), _marks("last", _CLOSERS)
    cut = F.regexp_extract_all(F.concat(opener, "text", closer), F.lit(_STATEMENT), F.lit(0))
    goes_on = (F.col("pos") == 0) & (F.col("first") != ";")
    is_open = (F.col("pos") == F.col("n") - 1) & (F.col("last") != ";")
    before = F.when(F.col("goes_on"), F.length(opener)).otherwise(0)
    after = F.when(F.col("is_open"), F.length(closer)).otherwise(0)
    bare = F.substring("part", before + 1, F.length("part") - before - after)
    return (
        chunks.select("file", "block", "chunk", "first", "last", cut.alias("parts"))
        # The outer form, as the inner one would cut twice to skip empty lists; their nulls end with the blanks.
        .select("*", F.size("parts").alias("n"), F.posexplode_outer("parts").alias("pos", "part"))
        .withColumns({"goes_on": goes_on, "is_open": is_open})
        .select(
            "file", "block", "chunk", "pos", "goes_on", "is_open",
            F.when(F.col("goes_on") | F.col("is_open"), bare).otherwise(F.col("part")).alias("value"),
        )
    )


def _marks(state: str, marks: dict[str, str]) -> Column:
    return F.coalesce(*(F.when(F.col(state) == letter, mark) for letter, mark in marks.items()), F.lit(""))


def _joined(parts: DataFrame) -> DataFrame:
    """The statements across chunks, a few parts each, from the first that does not go on."""
    so_far = Window.partitionBy("file").orderBy("block", "chunk", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("statement", F.count_if(~F.col("goes_on")).over(so_far))
    texts = numbered.groupBy("file", "statement").agg(_in_order("value", "block", "chunk", "pos").alias("text"))
    return texts.select(F.explode(F.regexp_extract_all("text", F.lit(_STATEMENT), F.lit(0))).alias("value"))


def load_target(spark: SparkSession, path: str) -> TargetSchema:
    """The target schema of the one CREATE TABLE statement in a DDL file."""
    statements = scan_statements(spark, path).withColumn("statement", F.monotonically_increasing_id())
    return target_from_catalog(parse_ddl(statements))
