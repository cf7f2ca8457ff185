"""Small inputs for the operators: nulls, blanks, ties, repeats, long texts, clashing names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def clashing(df):
    """With extra columns named like results and like helpers of the operators."""
    extra = ("row", "key", "kept", "copy", "position", "print", "component_id", "words", "length", "bucket", "spans", "score", "rate", "id", "drop")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in extra})


def edge_rows():
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (4, "a b c"), (5, "a b c"), (None, "no id"), (None, None), (6, long), (7, "Ä ß é 日本語 🙂 x")]
