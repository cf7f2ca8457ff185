"""Personal data: patterns, and terms that give away who is meant; no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costflow.llm.common import text_of, written

# Fixed values of the contract, with the same matches in linear time: possessive
# where nothing can follow the repeated group, which needs no stack per repeat; a
# match begins a run or follows the last match, so no run is read from each of
# its characters; runs of fewer digits than a card has are left out here rather
# than by VALID.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
#: What a text must hold for the pattern to be tried at all.
SIGNS = {"email": "@", "ip": ".", "phone": "+"}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda m: F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}

#: Terms: letters, so many at least; looked for in the whole of a text with base spans.
TERM = r"\p{L}{4,}"
#: A term that begins with a capital behind a word, so not because a sentence begins with it. The
#: capital is looked for first, and what stands before it only then.
NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:] .)\p{L}{3,}+"
#: So many documents at the entity's share of the corpus are added to those of a term, which draws
#: terms of few documents a little towards telling nothing.
PRIOR = 0.1
#: Shares of the entity's information that a term may disclose.
GENERALISE, REMOVE = 0.5, 0.9
#: Harmless terms of one kind that chance may be expected to tie to an entity as closely; see `disclosing`.
CHANCE = 0.1
#: Keys over which the terms of one number of texts are dealt.
SALTS = 64


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


#: Matches that are placed together; appending to an array copies it, so arrays are kept this short.
BLOCK = 256


def _sums(values: Column) -> Column:
    """The sum before each of a few numbers."""
    step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(values, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)["out"]


def steps_of(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<gap, value>> of the matches `found`, each with the code points between it and the one before.

    To be a column of its own before `located` uses it: inside of a lambda an
    expression is worked out again for each element.
    """
    gaps = F.slice(F.transform(F.split(text, pattern), F.length), 1, F.size(found))
    empty = F.array().cast("array<struct<gap:int,value:string>>")
    return F.when(F.size(found) > 0, F.arrays_zip(gaps.alias("gap"), found.alias("value"))).otherwise(empty)


def located(steps: Column) -> Column:
    """array<struct<start, end, value>> of the matches, in code points, from a column of `steps_of`.

    The gaps between matches and the matches before them add up to the starts,
    first within blocks of matches, then over the blocks.
    """
    blocks = F.transform(F.sequence(F.lit(1), F.size(steps), F.lit(BLOCK)), lambda at: F.slice(steps, at, BLOCK))

    def placed(block: Column) -> Column:
        sizes = F.transform(block, lambda x: x["gap"] + F.length(x["value"]))
        inside = F.arrays_zip(_sums(sizes).alias("before"), block.alias("step"))
        total = F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
        return F.struct(inside.alias("inside"), total.alias("total"))

    def from_start(block: Column, before: Column) -> Column:
        at = lambda x: (before + x["before"] + x["step"]["gap"]).cast("int")
        return F.transform(
            block["inside"],
            lambda x: F.struct(at(x).alias("start"), (at(x) + F.length(x["step"]["value"])).alias("end"), x["step"]["value"].alias("value")),
        )

    # The array of one element holds the blocks once for their own use and that of their sums.
    whole = F.flatten(
        F.flatten(
            F.transform(
                F.array(F.transform(blocks, placed)),
                lambda b: F.zip_with(b, _sums(F.transform(b, lambda x: x["total"])), from_start),
            )
        )
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(steps) > 0, whole).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text, base): base spans of each row, by kind and start.

    `base` is array<struct<no, kind, start, end, value>>; `mark` is a hash of the
    text, which tells rows of one doc_id apart.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    none = F.array().cast("array<string>")
    found = rows.select(
        "*",
        *(
            (F.when(F.col("text").contains(SIGNS[k]), matches(F.col("text"), p)).otherwise(none) if k in SIGNS else matches(F.col("text"), p)).alias(f"m_{k}")
            for k, p in PATTERNS.items()
        ),
    )
    steps = found.select("doc_id", "mark", "text", *(steps_of(F.col("text"), F.col(f"m_{k}"), p).alias(f"p_{k}") for k, p in PATTERNS.items()))
    placed = steps.select("doc_id", "mark", "text", *(located(F.col(f"p_{k}")).alias(f"s_{k}") for k in PATTERNS))

    def named(no: int, kind: str) -> Column:
        good = F.filter(F.col(f"s_{kind}"), lambda s: VALID[kind](s["value"]))
        return F.transform(good, lambda s: F.struct(F.lit(no).alias("no"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return placed.select("doc_id", "mark", "text", F.concat(*(named(i, k) for i, k in enumerate(PATTERNS))).alias("base"))


def _entity(span: Column) -> Column:
    """The protected entity of a span: kind and value, digits alone for numbers."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"], plain)


def holders(spans: DataFrame) -> DataFrame:
    """(mark, text, base): each text with base spans once."""
    return spans.where(F.size("base") > 0).groupBy("mark").agg(F.first("text").alias("text"), F.first("base").alias("base"))


def places(held: DataFrame) -> DataFrame:
    """(mark, start, end, term) of every term that touches no base span, the term in lower case.

    Spans and terms of a text are put in one order; a term is apart if all spans
    before it end before it and the next one begins behind it.
    """
    # Dealt by text before the work begins; the windows below need no other order of tasks.
    dealt = held.repartition(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), "mark")
    found = dealt.select("mark", "text", "base", matches(F.col("text"), TERM).alias("found"))
    steps = found.select("mark", "base", steps_of(F.col("text"), F.col("found"), TERM).alias("steps"))
    term = lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("late"), t["end"].alias("end"), F.lower(t["value"]).alias("term"))
    span = lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("late"), s["end"].alias("end"), F.lit(None).cast("string").alias("term"))
    both = steps.select("mark", "base", located(F.col("steps")).alias("whole"))
    each = both.select("mark", F.explode(F.concat(F.transform("base", span), F.transform("whole", term))).alias("at")).select("mark", "at.*")
    # Both frames grow from the start of their order; one that shrinks to the end is worked out again for each row.
    forward, back = Window.partitionBy("mark").orderBy("start", "late"), Window.partitionBy("mark").orderBy(F.desc("start"), F.desc("late"))
    is_span = F.col("term").isNull()
    reach = F.max(F.when(is_span, F.col("end"))).over(forward.rowsBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(is_span, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, 0))
    apart = (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("start")) & F.coalesce(F.col("following") >= F.col("end"), F.lit(True))
    return each.withColumns({"reach": reach, "following": following}).where(~is_span & apart).select("mark", "start", "end", "term")


def entity_classes(held: DataFrame) -> DataFrame:
    """(mark, class, n_entity): what stands for the entities of a text.

    Entities that are in the very same texts cannot be told apart by counting, so
    they are one class: a text with thousands of addresses found nowhere else has
    one class for them all. A class is named by two hashes over its texts.
    """
    entities = held.select("mark", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    told = entities.groupBy("entity").agg(
        F.count("*").alias("n_entity"), F.bit_xor(F.xxhash64("mark")).alias("h1"), F.bit_xor(F.xxhash64("mark", F.lit(1))).alias("h2")
    )
    named = entities.join(told, "entity").select("mark", F.struct("n_entity", "h1", "h2").alias("class"))
    return named.distinct().select("mark", "class", F.col("class.n_entity").alias("n_entity"))


def corpus_terms(texts: DataFrame) -> DataFrame:
    """(term, n_term, n_alike, name): distinct texts with the term, how many such terms there are, and whether it is like a name.

    A name is never in lower case, and somewhere has a capital inside a sentence.
    `n_alike` counts the terms that as many texts hold and that are names or not as well.
    """
    # Every term of a text is one row; a sign at its end says that it has a capital wherever it stands
    # there, and where (1 at the start of sentences, 2 inside). Plain strings are quick to count.
    every = lambda text, pattern: F.array_distinct(matches(text, pattern))
    named = F.split(F.lower(F.array_join(matches(F.col("text"), NAME), " ")), " ")
    found = texts.select(every(F.col("text"), TERM).alias("said"), every(F.lower("text"), TERM).alias("low"), named.alias("named"))
    found = found.select(F.array_intersect("low", "said").alias("small"), F.array_except("low", "said").alias("capital"), "named")
    signed = lambda terms, sign: F.transform(terms, lambda t: F.concat(t, F.lit(sign)))
    inside, outside = F.array_intersect("capital", "named"), F.array_except("capital", "named")
    each = found.select(F.explode(F.concat("small", signed(outside, "1"), signed(inside, "2"))).alias("at"))
    counted = written(each.groupBy("at").agg(F.count("*").alias("n")), "terms")
    sign = F.regexp_extract("at", "[12]$", 0)
    counts = counted.groupBy(F.rtrim("at", F.lit("12")).alias("term")).agg(
        F.sum("n").alias("n_term"), (F.bool_and(sign != "") & F.bool_or(sign == "2")).alias("name")
    )
    alike = counts.groupBy("n_term", "name").agg(F.count("*").alias("n_alike"))
    # Half of all terms are in one text only: each number of texts is dealt over SALTS keys.
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    alike = alike.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(alike, ["n_term", "name", "salt"]).select("term", "n_term", "n_alike", "name")


def together(classes: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """(mark, class, term, n, n_entity, n_term, n_alike, name): entities and terms in one text, with their counts of distinct texts.

    Pairs that cannot disclose GENERALISE, even if all texts of the entity hold the
    term, are left out: those with n_term ** 2 > n * n_entity. Terms that are so for
    every entity of their text go before the pairs are made. Copies of a text count
    once, and texts with a term are counted over the whole corpus.
    """
    texts = docs.select(F.xxhash64(text_of(docs)).alias("mark"), text_of(docs).alias("text"))
    n = texts.agg(F.count_distinct("mark").alias("n"))  # one row
    counts = corpus_terms(texts.groupBy("mark").agg(F.first("text").alias("text")))
    most = classes.groupBy("mark").agg(F.max("n_entity").alias("most"))
    rare = lambda entity: F.col("n_term") * F.col("n_term") <= F.col("n") * F.col(entity)
    terms = found.select("mark", "term").distinct().join(counts, "term").join(F.broadcast(n))
    terms = terms.join(most, "mark").where(rare("most")).drop("most")
    return classes.join(terms, "mark").where(rare("n_entity"))


def disclosing(pairs: DataFrame) -> DataFrame:
    """(class, term, disclosed): terms that give away at least GENERALISE of an entity, and not by chance.

    Pointwise mutual information of term and entity over the entity's information
    content, from counts of distinct texts; the entity's share of the texts with
    the term is smoothed by PRIOR.

    Evidence: were the texts of a term dealt by chance, at least n_pair of them
    would be among those of the entity with a probability of about
    C(n_term, n_pair) * (n_entity / n) ** n_pair. Times the number of terms of the
    same kind (`corpus_terms`), that is how many such ties chance alone makes for
    this entity; a word counts only where it is CHANCE at most. So a word of one
    text tells nothing where thousands of words are in one text only. What is like
    a name needs no such evidence: names are told to give people away.
    """
    counted = pairs.groupBy("class", "term").agg(F.count("*").alias("n_pair"), *(F.max(c).alias(c) for c in ("n", "n_entity", "n_term", "n_alike", "name")))
    share = F.col("n_entity") / F.col("n")
    given = (F.col("n_pair") + PRIOR * share) / (F.col("n_term") + PRIOR)
    told = F.when(share < 1, F.log2(given / share) / -F.log2(share)).otherwise(0.0)
    # Of a term's texts all or some are with the entity; (e t / k) ** k is over C(t, k).
    ways = F.when(F.col("n_pair") == F.col("n_term"), 0.0).otherwise(F.col("n_pair") * (1 + F.log(F.col("n_term") / F.col("n_pair"))))
    chance = F.log("n_alike") + F.least(F.lit(0.0), ways + F.col("n_pair") * F.log(share))
    sure = F.col("name") | (chance <= F.log(F.lit(CHANCE)))
    return counted.select("class", "term", told.alias("disclosed"), sure.alias("sure")).where((F.col("disclosed") >= GENERALISE) & F.col("sure")).drop("sure")


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans) for each row of `docs` (doc_id, text).

    `spans` is array<struct<no, kind, start, end, disclosed>> by kind as in KINDS
    and then start: the base spans, and anywhere in the same text the terms whose
    co-occurrence over the corpus gives a protected entity of it away. Null texts
    are empty. Rows that repeat a text share their spans. Other columns are not
    read. An empty table gives an empty one.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    found = base_spans(narrow)
    plain = F.transform("base", lambda s: F.struct(s["no"], s["kind"], s["start"], s["end"], F.lit(None).cast("double").alias("disclosed")))
    # The text goes along where it is needed again, so that no pattern is tried twice.
    found = written(found.withColumn("text", F.when(F.size("base") > 0, F.col("text"))), "base_spans")
    base = found.select("doc_id", "mark", plain.alias("base"))
    held = written(holders(found), "holders")
    at = written(places(held), "places")
    pairs = written(together(written(entity_classes(held), "classes"), at, narrow), "pairs")
    telling = written(disclosing(pairs), "disclosing")
    told = pairs.join(telling, ["class", "term"]).groupBy("mark", "term").agg(F.max("disclosed").alias("disclosed"))
    terms = (
        at.join(told, ["mark", "term"])
        .groupBy(F.col("mark").alias("term_mark"))
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.lit(len(PATTERNS)).alias("no"), F.lit("term").alias("kind"), "start", "end", "disclosed"))
            ).alias("terms")
        )
    )
    every = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat("base", "terms"))
    return base.join(terms, base["mark"] == terms["term_mark"], "left").select("doc_id", "mark", every.alias("spans"))


def named_spans(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, clean_text, spans): base spans become `<KIND>`, terms `<TERM>` or nothing.

    A term is generalised from GENERALISE on and removed from REMOVE on. Spans
    that overlap an earlier one are cut to the rest.
    """
    spans = written(find_spans(docs).dropDuplicates(["doc_id", "mark"]), "spans").withColumnsRenamed({"doc_id": "span_doc", "mark": "span_mark"})
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).withColumn("mark", F.xxhash64("text"))
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans["span_doc"]) & (rows["mark"] == spans["span_mark"]))
    word = lambda s: F.when((s["kind"] == "term") & (s["disclosed"] >= REMOVE), "").otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), word(s).alias("word"))))
    walk = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["end"] <= a["at"], a["out"]).otherwise(
                F.concat(a["out"], F.array(F.substring(F.col("text"), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), s["word"]))
            ).alias("out"),
        ),
    )
    done = joined.select("doc_id", "text", "spans", walk.alias("w"))
    rest = F.substring(F.col("text"), F.col("w.at") + 1, F.length("text"))
    return done.select("doc_id", F.concat(F.array_join("w.out", ""), rest).alias("clean_text"), "spans")
