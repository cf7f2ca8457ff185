"""Quality rules with thresholds from the data's own quantiles; no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import SPACES, text_of, without, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: What the adaptive rules look at: whole numbers, so that any engine buckets them alike.
#: Per measure: its SQL over the base columns, and the least width of its fence.
MEASURES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 10),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 110),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 110),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 60),
}
#: A measure fails above the third quartile plus so many times the spread of the quartiles.
FENCE = 4
#: The wider group's fence counts like so many documents beside a group's own.
WIDER = 100


def _hit_starts(words: Column) -> Column:
    """Starts, in order, of the word windows that a text holds twice or more.

    Windows are told apart by 64-bit hashes within one text. Equal ones are
    neighbours after a sort, so a long text costs n log n.
    """
    at = lambda i: F.get(words, i)
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*(at(i + k) for k in range(WINDOW))).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) > WINDOW, F.sort_array(hashes))


def base_columns(docs: DataFrame) -> DataFrame:
    """(row, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    `row` is the whole input row. Words are `[^\\x20\\x09-\\x0D]+`; `n_lines`
    counts lines with a word, `n_dup_lines` those equal to an earlier one,
    `n_repeat_words` the words in three-word windows found twice or more.
    """
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    staged = docs.select(whole, text_of(docs).alias("text"))
    staged = staged.select("row", "text", words_of(F.col("text")).alias("words"))
    staged = staged.select(
        "row",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.instr("text", "\n") > 0, F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")).alias("lines"),
        _hit_starts(F.col("words")).alias("s"),
    )
    hash_at = lambda k: F.get(F.col("s"), k)["h"]
    twins = F.filter("s", lambda e, k: (e["h"] == hash_at(k - 1)) | (e["h"] == hash_at(k + 1)))
    staged = staged.select(
        "row", "text", "n_words", "lines", F.sort_array(F.transform(twins, lambda e: e["i"])).alias("starts")
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
    )["n"]
    return staged.select(
        "row",
        "text",
        "n_words",
        F.length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.coalesce(F.size("lines"), F.when(F.col("n_words") > 0, 1).otherwise(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def measured(base: DataFrame) -> DataFrame:
    """Base columns plus `base_failed` and the measures of the adaptive rules."""
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return base.withColumn("base_failed", F.expr(failed)).withColumns({m: F.expr(sql) for m, (sql, _) in MEASURES.items()})


def _bucket(value: Column) -> Column:
    """The value to ten significant bits: at most 512 buckets per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    return value - value % F.pow(F.lit(2), shift).cast("long")


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): a quantile sketch per language, source and measure.

    A sketch is its bucket counts; sketches merge by adding counts, which is what
    the partial aggregates do, so a hot source is summed where its rows are.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket")) for m in MEASURES))).alias("at")
    return (
        measures.where("n_words > 0")
        .select("lang", "source", pairs)
        .groupBy("lang", "source", "at.measure", "at.bucket")
        .agg(F.count("*").alias("n"))
    )


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles per group: the first bucket with at least that share at or below it.

    A window sorts the buckets of one group and measure: at most 512 for each
    power of two of the measure, however many documents there are.
    """
    names = ", ".join(keys)
    running = sketch.select(
        "*",
        F.expr(f"sum(n) over (partition by {names} order by bucket)").alias("below"),
        F.expr(f"sum(n) over (partition by {names})").alias("total"),
    )
    return running.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.expr("min(case when 4 * below >= total then bucket end)").alias("q1"),
        F.expr("min(case when 4 * below >= 3 * total then bucket end)").alias("q3"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the upper fence of each measure.

    Sketches are merged step by step: source within language, language, all. Each
    step has a fence of its own quartiles, and the one in use is the mean of it
    and the next wider one's, weighed by its documents and WIDER. So a large group
    stands for itself, a small one leans on its language and that on the corpus,
    and no fence jumps when a group grows by a document.
    """
    floors = F.element_at(F.create_map(*(F.lit(x) for m, (_, f) in MEASURES.items() for x in (m, f))), F.col("measure"))
    fence = F.col("q3") + FENCE * F.greatest(F.col("q3") - F.col("q1"), floors)

    def step(keys: list[str], prefix: str) -> DataFrame:
        merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        found = _quantiles(merged, [*keys, "measure"])
        return found.select(*(F.col(k).alias(prefix + k) for k in [*keys, "measure"]), F.col("total").alias(f"{prefix}n"), fence.alias(f"{prefix}fence"))

    own, langs, whole = step(["lang", "source"], ""), step(["lang"], "l_"), step([], "w_")
    leaned = lambda n, f, wider: (F.col(n) * F.col(f) + WIDER * F.col(wider)) / (F.col(n) + WIDER)
    wide = langs.join(whole, F.col("l_measure") == F.col("w_measure")).withColumn("l_used", leaned("l_n", "l_fence", "w_fence"))
    same = own["lang"].eqNullSafe(wide["l_lang"]) & (own["measure"] == wide["l_measure"])
    used = own.join(wide, same).withColumn("used", leaned("n", "fence", "l_used"))
    return used.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == m, F.col("used"))).alias(f"max_{m}") for m in MEASURES))


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """`measures` joined with the fences of its language and source, plus `kept`."""
    limits = limits.select(F.col("lang").alias("limit_lang"), F.col("source").alias("limit_source"), *(f"max_{m}" for m in MEASURES))
    same = measures["lang"].eqNullSafe(limits["limit_lang"]) & measures["source"].eqNullSafe(limits["limit_source"])
    inside = ~F.col("base_failed")
    for m in MEASURES:
        inside = inside & (F.col(m) <= F.col(f"max_{m}"))
    return measures.join(limits, same, "left").withColumn("kept", F.coalesce(inside, F.lit(False)))


def _with_groups(docs: DataFrame) -> DataFrame:
    lang, source = (F.col(f"row.{c}").cast("string").alias(c) for c in ("lang", "source"))
    return measured(base_columns(docs)).select("*", lang, source)


def apply_rules(docs: DataFrame) -> DataFrame:
    """A verdict for each row of `docs` (doc_id, text, lang, source).

    (doc_id, lang, source, base columns, base_failed, measures, fences, kept).
    `kept` is false if `base_failed`, else whether every measure is within the
    fence of its language and source (`thresholds`): third quartile plus FENCE
    times the spread of the quartiles (at least the measure's floor). Null and blank texts have no
    words and fail. Null languages and sources are groups of their own. Repeated
    rows count each. Other columns are not read. An empty table gives an empty one.
    """
    narrow = written(_with_groups(docs.select("doc_id", "text", "lang", "source")).select("row.doc_id", "lang", "source", *BASE, *MEASURES), "measures")
    return judged(narrow, written(thresholds(sketches(narrow)), "thresholds"))


BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with its columns, whatever their names.

    Measures are worked out twice, for the sketches and for the filter, rather
    than written beside the whole texts.
    """
    groups = _with_groups(docs)
    limits = written(thresholds(sketches(groups)), "thresholds")
    return judged(groups, limits).where("kept").select("row.*")
