import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costflow.operators.flatten import flatten_append, flatten_in_place
from costflow.operators.layout import partition_last
from costflow.operators.names import lowercase_nested, lowercase_top
from costflow.plans.chain import standardize

NESTED = (
    "Foo struct<Bar: struct<Baz: int>, Qux: string>, Items array<struct<Price: double>>, "
    "Attrs map<string, struct<Key: int>>, `Dot.Name` int"
)


@pytest.fixture()
def nested(spark):
    rows = [
        (((1,), "a"), [(2.0,)], {"K": (3,)}, 4),
        (None, None, None, None),
        ((None, None), [], {}, 5),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_nested_names(nested):
    low = lowercase_nested(nested)
    assert low.schema.simpleString() == (
        "struct<foo:struct<bar:struct<baz:int>,qux:string>,items:array<struct<Price:double>>,"
        "attrs:map<string,struct<Key:int>>,dot.name:int>"
    )
    assert low.collect() == nested.collect()


def test_null_structs_stay_null(nested):
    low = lowercase_nested(nested)
    assert low.where("foo IS NULL").count() == 1
    assert low.where("foo IS NOT NULL AND foo.bar IS NULL").count() == 1


def test_into_collections(nested):
    low = lowercase_nested(nested, into_collections=True)
    assert "array<struct<price:double>>" in low.schema.simpleString()
    assert "map<string,struct<key:int>>" in low.schema.simpleString()
    assert low.collect() == nested.collect()


def test_top_names_only(nested):
    assert lowercase_top(nested).columns == ["foo", "items", "attrs", "dot.name"]
    assert "Qux" in lowercase_top(nested).schema["foo"].dataType.names


def test_clashing_names_are_refused(spark, setting):
    setting("spark.sql.caseSensitive", "true")
    df = spark.sql("SELECT 1 AS Foo, 2 AS foo")
    for rename in (lowercase_nested, lowercase_top):
        with pytest.raises(ValueError, match="foo"):
            rename(df)
    inner = spark.sql("SELECT named_struct('A', 1, 'a', 2) AS s")
    with pytest.raises(ValueError, match="in s"):
        lowercase_nested(inner)


COSTS = "id int, costcurrencyvendorraw struct<Cost: double>, x int, costcurrencyvendorusd struct<Cost: double, Code: string>"


@pytest.fixture()
def costs(spark):
    return spark.createDataFrame([(1, (1.5,), 7, (2.5, "USD")), (2, None, 8, None)], COSTS)


def test_flatten_at_the_end(costs):
    flat = flatten_append(costs)
    assert flat.columns == [
        "id", "x", "costcurrencyvendorusd_cost", "costcurrencyvendorusd_code", "costcurrencyvendorraw_cost"
    ]
    assert [tuple(r) for r in flat.collect()] == [(1, 7, 2.5, "USD", 1.5), (2, 8, None, None, None)]


def test_flatten_in_place(costs):
    assert flatten_in_place(costs).columns == [
        "id", "costcurrencyvendorraw_cost", "x", "costcurrencyvendorusd_cost", "costcurrencyvendorusd_code"
    ]


def test_flatten_leaves_other_columns(spark):
    df = spark.sql("SELECT 1 AS costcurrencyvendorusd, named_struct('a', 1) AS other")
    assert flatten_append(df).schema == df.schema
    assert flatten_in_place(df).schema == df.schema


def test_flatten_clash_is_refused(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS costcurrencyvendorusd, 2 AS costcurrencyvendorusd_x")
    with pytest.raises(ValueError, match="costcurrencyvendorusd_x"):
        flatten_append(df)


def test_partition_column_last(spark):
    df = spark.sql("SELECT '2025-01-02' AS partitiondate, 1 AS a, 2 AS b")
    last = partition_last(df)
    assert last.columns == ["a", "b", "partitiondate"]
    assert isinstance(last.schema["partitiondate"].dataType, T.DateType)
    assert partition_last(df.drop("partitiondate")).columns == ["a", "b"]


def test_short_cut_equals_separate_steps(spark):
    df = spark.sql(
        "SELECT 1 AS Id, named_struct('Cost', 2.5D, 'Deep', named_struct('In', 3)) AS CostCurrencyVendorUSD,"
        " named_struct('Up', 1) AS Other"
    ).union(spark.sql("SELECT 2, NULL, NULL"))
    stepwise = flatten_append(lowercase_nested(df))
    direct = standardize(df, None)
    assert direct.schema.simpleString() == stepwise.schema.simpleString()
    assert direct.collect() == stepwise.collect()
    assert direct.where(F.col("costcurrencyvendorusd_deep.in") == 3).count() == 1
