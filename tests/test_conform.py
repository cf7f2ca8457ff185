from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from costflow.operators.catalog import TargetSchema
from costflow.operators.conform import cast_rejects, conform, schema_report

TARGET = TargetSchema.of(
    [("Id", "string"), ("N", "decimal(38,0)"), ("T", "timestamp_ntz"), ("D", "double"), ("Gone", "date")]
)


def test_types_and_order(spark):
    df = spark.sql("SELECT 1L AS id, 2 AS n, 1756684800 AS t, 3.5D AS d, 'x' AS other")
    out = conform(df, TARGET)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("id", "string"), ("n", "decimal(38,0)"), ("t", "timestamp_ntz"), ("d", "double"), ("other", "string")
    ]
    assert out.first().t == datetime(2025, 9, 1)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("TIMESTAMP_NTZ'2025-09-01 01:02:03'", datetime(2025, 9, 1, 1, 2, 3)),
        ("TIMESTAMP_NTZ'2025-09-01 01:02:03.5'", datetime(2025, 9, 1, 1, 2, 3, 500000)),
        ("TIMESTAMP'2025-09-01 01:02:03'", datetime(2025, 9, 1, 1, 2, 3)),
        ("DATE'2025-09-01'", datetime(2025, 9, 1)),
        ("'2025-09-01 01:02:03'", datetime(2025, 9, 1, 1, 2, 3)),
        ("'1756684800'", datetime(2025, 9, 1)),
        ("'1756684800123456789'", datetime(2025, 9, 1)),
        ("'9999999999999999999'", None),
        ("CAST(NULL AS STRING)", None),
        ("1756684800123L", datetime(2025, 9, 1)),
        ("CAST(7 AS SMALLINT)", None),
        ("1756684800.0D", datetime(2025, 9, 1)),
        ("CAST(1756684800123 AS DECIMAL(38,2))", datetime(2025, 9, 1)),
        ("1756684800.5D", None),
        ("DOUBLE('NaN')", None),
        ("1e30D", None),
    ],
)
def test_timestamp_sources(spark, value, expected):
    assert conform(spark.sql(f"SELECT {value} AS t"), TARGET).first().t == expected


def test_missing_policies(spark):
    df = spark.sql("SELECT '1' AS id, CAST(2 AS DECIMAL(38,0)) AS n")
    assert conform(df, TARGET).columns == ["id", "n"]
    filled = conform(df, TARGET, missing="fill")
    assert filled.columns == ["id", "n", "t", "d", "gone"]
    assert filled.schema["gone"].dataType.simpleString() == "date"
    with pytest.raises(ValueError, match="gone"):
        conform(df, TARGET, missing="fail")


def test_extra_policies(spark):
    df = spark.sql("SELECT '1' AS id, 2 AS other")
    assert conform(df, TARGET, extra="drop").columns == ["id"]
    with pytest.raises(ValueError, match="other"):
        conform(df, TARGET, extra="fail")
    with pytest.raises(ValueError, match="extra"):
        conform(df, TARGET, extra="maybe")


BAD = "SELECT * FROM VALUES ('abc'), (''), ('1e20'), ('7'), (NULL) AS v(n)"


def test_bad_values_fail_or_become_null(spark):
    df = spark.sql(BAD)
    with pytest.raises(PySparkException):
        conform(df, TARGET).collect()
    rows = conform(df, TARGET, on_error="null").collect()
    assert [r.n and int(r.n) for r in rows] == [None, None, 10**20, 7, None]


def test_reject_counts(spark):
    df = spark.sql(f"SELECT n, n AS d, n AS t, 5 AS other FROM ({BAD})")
    counts = {r["name"]: (r.target_type, r.filled, r.rejected) for r in cast_rejects(df, TARGET).collect()}
    assert counts == {
        "n": ("decimal(38,0)", 4, 2),
        "d": ("double", 4, 2),
        "t": ("timestamp_ntz", 4, 4),
    }


def test_schema_report(spark):
    df = spark.sql("SELECT 1L AS t, 2 AS n, 'x' AS id, 3 AS other")
    report = {r["name"]: (r.source_type, r.target_type, r.status) for r in schema_report(df, TARGET).collect()}
    assert report == {
        "t": ("bigint", "timestamp_ntz", "epoch"),
        "n": ("int", "decimal(38,0)", "cast"),
        "id": ("string", "string", "same"),
        "other": ("int", None, "extra"),
        "d": (None, "double", "missing"),
        "gone": (None, "date", "missing"),
    }
