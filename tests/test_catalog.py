import pytest

from costflow.operators.catalog import TargetSchema, map_types, parse_ddl, target_from_text
from costflow.plans.feed import wide_ddl
from costflow.sources.text import load_target, scan_statements

TYPES = {
    "FLOAT": "double",
    "DOUBLE PRECISION": "double",
    "REAL": "double",
    "REAL NOT NULL": "string",
    "INT": "bigint",
    "tinyint": "bigint",
    "NUMBER": "bigint",
    "NUMBER(9)": "int",
    "NUMBER(9,0)": "int",
    "NUMBER(10,0)": "bigint",
    "NUMBER(18,0)": "bigint",
    "NUMBER(19,0)": "decimal(19,0)",
    "NUMBER(38,0)": "decimal(38,0)",
    "NUMBER(40,5)": "decimal(38,5)",
    "NUMBER(10,2)": "decimal(10,2)",
    "NUMBER(38,0) NOT NULL": "decimal(38,0)",
    "DECIMAL(10,0)": "decimal(10,0)",
    "DECIMAL": "string",
    "NUMERIC(12,3)": "decimal(12,3)",
    "NUMERIC(5)": "decimal(5,0)",
    "VARCHAR(10)": "string",
    "STRING": "string",
    "CHAR(1)": "string",
    "TEXT": "string",
    "BOOLEAN": "boolean",
    "BOOLEAN NOT NULL": "string",
    "DATE": "date",
    "DATE NOT NULL": "string",
    "TIMESTAMP_NTZ(9)": "timestamp_ntz",
    "TIMESTAMP_TZ": "timestamp_ntz",
    "TIME": "string",
    "VARIANT": "string",
}
UNKNOWN = {"REAL NOT NULL", "DECIMAL", "BOOLEAN NOT NULL", "DATE NOT NULL", "TIME", "VARIANT"}

SMALL = """
create or replace TABLE "DB-1 (x)".LIVE.COSTS cluster by ("UsageStartTime", to_date("Day"))(
	"UsageStartTime" TIMESTAMP_NTZ(9),
	"Cost, (net)" FLOAT,
	TAGS VARCHAR(16777216), -- a comment, with "noise" (
	"Rate" NUMBER(38, 4) NOT NULL COMMENT 'it''s a rate, (really)',
	/* block, comment */ "Quoted--Name" DATE,
	ID VARCHAR(10), "Second" BOOLEAN,
	CONSTRAINT pk PRIMARY KEY (ID),
	PRIMARY KEY (ID),
	"primary" INT
);
"""


def test_type_mapping(spark):
    rows = map_types(spark.createDataFrame([(t,) for t in TYPES], "type_text string")).collect()
    assert {r.type_text: r.spark_type for r in rows} == TYPES
    assert {r.type_text for r in rows if not r.recognized} == UNKNOWN


def test_small_ddl(spark):
    rows = parse_ddl(spark.createDataFrame([(SMALL,)], "value string")).orderBy("ordinal").collect()
    assert [(r.name, r.type_text) for r in rows] == [
        ("UsageStartTime", "TIMESTAMP_NTZ(9)"),
        ("Cost, (net)", "FLOAT"),
        ("TAGS", "VARCHAR(16777216)"),
        ("Rate", "NUMBER(38, 4) NOT NULL COMMENT"),
        ("Quoted--Name", "DATE"),
        ("ID", "VARCHAR(10)"),
        ("Second", "BOOLEAN"),
        ("primary", "INT"),
    ]


def test_wide_ddl(spark):
    target = target_from_text(spark, wide_ddl())
    kinds = [c.spark_type for c in target.columns]
    assert len(kinds) == 507
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {
        "string": 373, "double": 124, "decimal(38,0)": 6, "timestamp_ntz": 2, "date": 1, "boolean": 1
    }
    assert target.columns[0].name == "Measure1"
    assert not target.unrecognized()


def test_texts_without_a_table(spark):
    empty = spark.createDataFrame([("select 1",), ("",), (None,)], "value string")
    assert parse_ddl(empty).count() == 0
    with pytest.raises(ValueError, match="no column list"):
        target_from_text(spark, "select 1")


def test_files_of_statements(spark, tmp_path):
    (tmp_path / "a.sql").write_text("create table A (X INT);\ncreate table B (\n Y DATE,\n Z TEXT\n);\n")
    (tmp_path / "b.sql").write_text("create table C (W FLOAT)")
    rows = parse_ddl(scan_statements(spark, str(tmp_path))).collect()
    assert {(r.table_name, r.ordinal, r.name) for r in rows} == {
        ("A", 1, "X"), ("B", 1, "Y"), ("B", 2, "Z"), ("C", 1, "W")
    }


def test_load_target_from_file(spark, tmp_path):
    path = tmp_path / "target.sql"
    path.write_text(SMALL)
    target = load_target(spark, str(path))
    assert target.types()["tags"].simpleString() == "string"
    assert target.struct().names[0] == "usagestarttime"


def test_one_table_only(spark):
    two = spark.createDataFrame([("create table A (X INT)",), ("create table B (Y INT)",)], "value string")
    from costflow.operators.catalog import target_from_catalog

    with pytest.raises(ValueError, match="more than one table"):
        target_from_catalog(parse_ddl(two))


def test_last_of_equal_names_counts():
    target = TargetSchema.of([("A", "int"), ("a", "string")])
    assert target.types()["a"].simpleString() == "string"


def test_statements_end_at_semicolons_outside_quotes_and_comments(spark, tmp_path):
    from costflow.sources.text import load_target, scan_statements

    text = "CREATE TABLE t ( -- first; second\n a INT, /* x; y */ \"b\"\"c\" NUMBER(12345678901,2), d VARCHAR(9) COMMENT 'a; b')"
    (tmp_path / "one.sql").write_text(text + ";\n")
    target = load_target(spark, str(tmp_path / "one.sql"))
    assert [(c.name, c.spark_type) for c in target.columns] == [("a", "bigint"), ('b"c', "decimal(38,2)"), ("d", "string")]
    (tmp_path / "two.sql").write_text(text + ";" + text)
    assert scan_statements(spark, str(tmp_path / "two.sql")).count() == 2
    with pytest.raises(ValueError, match="more than one table"):
        load_target(spark, str(tmp_path / "two.sql"))


def test_deep_parentheses_and_constraints(spark):
    from costflow.operators.catalog import target_from_text

    ddl = "CREATE TABLE t (a INT DEFAULT (f(g(h(i(1,2),3)))), KEY VARCHAR(3), UNIQUE (a), CHECK (a > 0), PRIMARY KEY (a), b DATE)"
    assert [c.name for c in target_from_text(spark, ddl).columns] == ["a", "KEY", "b"]


def test_one_file_is_cut_by_many_tasks(spark, setting, tmp_path):
    from pyspark.sql import functions as F

    for key, value in (("files.maxPartitionBytes", "4000"), ("files.openCostInBytes", "1"), ("adaptive.coalescePartitions.enabled", "false")):
        setting(f"spark.sql.{key}", value)
    texts = [f"create table T{n} (\"a; {n}\" INT, -- b; c\n D DATE COMMENT 'it''s; e')" for n in range(2000)]
    (tmp_path / "all.sql").write_text(";\n".join(texts) + ";\n")
    found = scan_statements(spark, str(tmp_path)).select("value", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.value.strip() for r in found) == sorted(texts)
    assert len({r.task for r in found}) > 1


@pytest.mark.parametrize("bits", [0, 2])
def test_cutting_in_chunks_equals_cutting_whole_texts(spark, setting, tmp_path, monkeypatch, bits):
    import random
    import re

    from costflow.sources import text

    monkeypatch.setattr(text, "_CHUNK_BITS", bits)
    setting("spark.sql.files.maxPartitionBytes", "500")
    setting("spark.sql.files.openCostInBytes", "1")
    random.seed(bits)
    marks = [";", ";", "a", "é", '"', "'", "--", "\n", "/*", "*/", "-", "/", "*", " ", "''", "x;y", "\r\n"]
    wanted = []
    for n in range(60):
        weights = [random.choice((0.2, 1, 3)) for _ in marks]
        # The line break ends a comment, in which a `;` at the very end of a file would not be seen.
        whole = "".join(random.choices(marks, weights, k=random.choice((0, 3, 20, 100, 1000)))) + "\n"
        (tmp_path / f"{n}.sql").write_text(whole, newline="")
        wanted += [part for part in re.findall(text._STATEMENT, whole) if part.strip(" \t\r\n")]
    assert sorted(r.value for r in scan_statements(spark, str(tmp_path)).collect()) == sorted(wanted)


def test_column_lists_are_cut_alike_by_search_and_by_pieces(spark):
    import random

    from pyspark.sql import functions as F

    from costflow.operators.catalog import _PLAIN, _gathered, _items

    random.seed(3)
    marks = ["a", "b c", "é", ",", ",", '"', '""', '"x, ("', "(", ")", "(1,2)", "((", "))", "(((((1), 2))))", "\n", " "]
    texts = ["", ",", "a,", ",a", '"', "a\n", "(a,b),c\n"]
    for _ in range(3000):
        weights = [random.choice((0, 0.3, 1)) for _ in marks]
        texts.append("".join(random.choices(marks, [w + 0.01 for w in weights], k=random.choice((2, 5, 12)))))
    body = F.col("body")
    rows = spark.createDataFrame([(t,) for t in texts], "body string").select(
        "body", body.rlike(_PLAIN).alias("plain"), _items(body).alias("cut"), _gathered(body).alias("gathered")
    ).collect()
    assert {r.plain for r in rows} == {True, False}
    for r in rows:
        assert r.cut == r.gathered or r.cut == [*r.gathered, ""], r.body
