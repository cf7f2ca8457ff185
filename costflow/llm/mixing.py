"""Mixing sources to target weights by Poisson replication; no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import text_of, written

SEED = "mix-1"
#: Exponent of a source's share in the mixture: below 1 lifts small sources.
TEMPERATURE = 0.7
#: A larger rate is the sum of several draws of at most this mean.
MAX_MEAN = 16
#: Beyond so many steps the distribution of such a draw is 1 in double precision.
STEPS = 96


def uniform(*parts: Column) -> Column:
    """In [0, 1), from 52 bits of an MD5 over the parts."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate, draws, steps): mean repetitions of a document of each source.

    The mixture holds `size` times the characters of `docs`. A source's share of
    them is its weight, or without `weights` its own share to the power of
    `temperature`. Sources missing from `weights` have weight 0. `steps` is the
    distribution function of one draw at 0, 1, 2, ...
    """
    chars = docs.select(docs["source"].cast("string").alias("source"), F.length(text_of(docs)).alias("chars"))
    chars = chars.groupBy("source").agg(F.sum("chars").cast("double").alias("chars"))
    if weights is None:
        weight = F.pow(F.col("chars"), F.lit(temperature))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0))
    weighed = written(chars.withColumn("weight", weight), "weights")
    total = weighed.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    rate = F.when(
        (F.col("chars") > 0) & (F.col("all_weight") > 0), size * F.col("weight") / F.col("all_weight") * F.col("all_chars") / F.col("chars")
    ).otherwise(0.0)
    draws = F.greatest(F.ceil(F.col("rate") / MAX_MEAN), F.lit(1)).cast("int")
    first = F.exp(-F.col("mean"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(first.alias("p"), F.array(first).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * F.col("mean") / k).alias("p"),
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * F.col("mean") / k)).alias("cdf"),
        ),
    )["cdf"]
    return (
        weighed.join(F.broadcast(total))  # one row
        .withColumn("rate", rate)
        .withColumn("draws", draws)
        .withColumn("mean", F.col("rate") / F.col("draws"))
        .select("source", "rate", "draws", steps.alias("steps"))
    )


def replicate(docs: DataFrame, rate_table: DataFrame, seed: str = SEED) -> DataFrame:
    """(row, source, rate, copy, position): a row per copy of each row of `docs`.

    The number of copies is a Poisson variable with the source's rate, inverted
    at a number hashed from `seed` and doc_id: equal for every run and layout.
    `position` orders the copies at random.
    """
    table = rate_table.select(F.col("source").alias("rate_source"), "rate", "draws", "steps")
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    rows = docs.select(whole, docs["doc_id"].alias("id"), docs["source"].cast("string").alias("source"))
    joined = rows.join(table, rows["source"].eqNullSafe(table["rate_source"]))
    u = F.transform(F.sequence(F.lit(1), F.col("draws")), lambda j: uniform(F.lit(seed), F.col("id"), j))
    counted = joined.select("row", "id", "source", "rate", "steps", u.alias("us"))
    copies = F.aggregate("us", F.lit(0), lambda n, x: n + F.size(F.filter("steps", lambda c: c <= x)))
    counted = counted.select("row", "id", "source", "rate", copies.alias("copies")).where("copies > 0")
    spread = counted.select("row", "id", "source", "rate", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return spread.select("row", "source", "rate", "copy", uniform(F.lit(seed + "-order"), F.col("id"), F.col("copy")).alias("position"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, temperature: float = TEMPERATURE, seed: str = SEED) -> DataFrame:
    """(row, source, rate, copy, position), shuffled globally: in the order of `position`.

    Reads (doc_id, source, text) of `docs`; `row` is the whole input row. A null
    source is a source of its own (weight 0 if `weights` are given). Null and
    empty texts count no characters; a source of only such texts has rate 0 and
    vanishes. Rows of one doc_id have the same number of copies. The rate has no
    upper bound. An empty table gives an empty one.
    """
    table = written(rates(docs, weights, size, temperature), "rates")
    return replicate(docs, table, seed).orderBy("position", F.xxhash64("row", "copy"))
