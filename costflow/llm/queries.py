"""The registered queries of the operators, over whole tables, each with its checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.llm import chat, chunking, conversation_repair, decontamination, fill_in_middle, line_dedup, mixing, neighbours, packing, quality_rules, sanitise, simhash, warc
from costflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


def tokenizer_path() -> str:
    """The vocabulary file of the packing contract; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# -- pieces of the checking SQL ------------------------------------------------

SPACE_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WORDS_SQL = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"


# -- 1, document fingerprints --------------------------------------------------


@registered()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.fingerprints(table(spark, sf_dir, "documents"))


# -- 2, near-duplicates --------------------------------------------------------


@registered()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


# -- 3, chat formatting --------------------------------------------------------


@registered("""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (SELECT *, length(replace(role || text, chr(92), chr(92) || chr(92)))
    + (length(role) - length(replace(replace(replace(replace(role, '<s>', 's>'), '</s>', '/s>'), '[INST]', 'INST]'), '[/INST]', '/INST]')))
    + (length(text) - length(replace(replace(replace(replace(text, '<s>', 's>'), '</s>', '/s>'), '[INST]', 'INST]'), '[/INST]', '/INST]')))
    + length('<s>[INST][/INST]</s>') AS written FROM turns),
told AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST(sum(written) AS BIGINT) AS formatted_chars FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM told""")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(turns))


# -- 4, packing ----------------------------------------------------------------


@registered()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"), tokenizer_path())


# -- 5, personal data ----------------------------------------------------------


@registered()
def op5_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(number(kind) for kind in sanitise.PATTERNS),
        F.sha2(sanitise.named_spans(base), 256).alias("base_sha256"),
        sanitise.named_spans(F.col("spans")).alias("spans"),
    )


# -- 6, quality classifier -----------------------------------------------------


@registered()
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neighbours.score(docs, neighbours.fit(docs, table(spark, sf_dir, "labels")))


# -- 7, mixing -----------------------------------------------------------------

DRAW_SQL = "CAST(('0x' || substr(md5({}), 1, 13)) AS BIGINT) / 4503599627370496.0"


@registered(f"""
WITH sized AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars FROM documents GROUP BY source),
weighed AS (SELECT source, chars, pow(chars, {mixing.TEMPERATURE}) AS weight FROM sized),
rated AS (SELECT source, CASE WHEN chars > 0
    THEN weight / (SELECT sum(weight) FROM weighed) * (SELECT sum(chars) FROM weighed) / chars ELSE 0 END AS rate FROM weighed),
drawn AS (SELECT *, greatest(ceil(rate / {mixing.MAX_MEAN}), 1) AS draws FROM rated),
parts AS (SELECT *, [CASE WHEN rate = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END
         ELSE exp(k * ln(rate / draws) - rate / draws - lgamma(k + 1.0)) END for k in range(0, {mixing.STEPS} + 1)] AS p FROM drawn),
steps AS (SELECT source, rate, draws,
    [list_sum(p[1:k]) for k in range(1, {mixing.STEPS} + 2)] AS steps FROM parts),
counted AS (SELECT d.doc_id, d.source, s.rate, CAST(list_sum([
    len([c for c in steps if c <= {DRAW_SQL.format(f"'{mixing.SEED}:' || d.doc_id || ':' || j")}]) for j in range(1, CAST(draws AS BIGINT) + 1)]) AS INTEGER) AS copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
spread AS (SELECT doc_id, source, rate, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM counted)
SELECT doc_id, source, round(rate, 6) AS rate, copy,
  {DRAW_SQL.format(f"'{mixing.SEED}-order:' || doc_id || ':' || copy")} AS position FROM spread""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    limits = mixing.mix(docs)
    return limits.select("row.doc_id", "source", F.round("rate", 6).alias("rate"), "copy", "position")


# -- 8, WARC -------------------------------------------------------------------


@registered(f"""
WITH rows AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
marked AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM rows)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to FROM marked""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_records(warc.write_archives(table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# -- 9, line dedup -------------------------------------------------------------

_KEY = f"translate(trim(line, {SPACE_CHARS}), '{UPPER}', '{LOWER}')"


@registered(f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM split),
keyed AS (SELECT *, {_KEY} AS key FROM lines),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS}),
marked AS (SELECT k.*, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


# -- 10, quality rules ---------------------------------------------------------

_MEASURES = {
    "symbols": ("1000 * n_symbols // greatest(word_chars, 1)", quality_rules.MEASURES["symbols"][1]),
    "dup_lines": ("1000 * n_dup_lines // greatest(n_lines, 1)", quality_rules.MEASURES["dup_lines"][1]),
    "repeats": ("1000 * n_repeat_words // greatest(n_words, 1)", quality_rules.MEASURES["repeats"][1]),
    "word_length": ("100 * word_chars // greatest(n_words, 1)", quality_rules.MEASURES["word_length"][1]),
}
_QUARTILES = """max(total) AS total, min(CASE WHEN 4 * below >= total THEN bucket END) AS q1,
  min(CASE WHEN 4 * below >= 3 * total THEN bucket END) AS q3"""
_FLOOR = "CASE measure " + " ".join(f"WHEN '{m}' THEN {f}" for m, (_, f) in _MEASURES.items()) + " END"


def _step(name: str, keys: str) -> str:
    """The fences of one step of merged sketches; `keys` ends in a comma."""
    return f"""{name} AS (SELECT {keys}measure, total, q3 + {quality_rules.FENCE} * greatest(q3 - q1, {_FLOOR}) AS fence
  FROM (SELECT {keys}measure, {_QUARTILES} FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) AS below,
    sum(n) OVER (PARTITION BY {keys}measure) AS total FROM (SELECT {keys}measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL))"""


@registered(rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, {WORDS_SQL} AS words,
  [x for x in string_split(text, chr(10)) if trim(x, {SPACE_CHARS}) <> ''] AS lines FROM docs),
windows AS (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split),
hits AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM windows),
covered AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM hits WHERE n > 1) GROUP BY rid),
base AS (SELECT doc_id, lang, source, len(words) AS n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM split LEFT JOIN covered USING (rid)),
measures AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  {", ".join(f"{sql} AS m_{m}" for m, (sql, _) in _MEASURES.items())} FROM base),
long AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, m_{m} AS v FROM measures WHERE n_words > 0" for m in _MEASURES)}),
sketch AS (SELECT lang, source, measure, v - v % CAST(pow(2, greatest(length(bin(v)) - 10, 0)) AS BIGINT) AS bucket, count(*) AS n
  FROM long GROUP BY ALL),
{_step("own", "lang, source, ")}, {_step("langs", "lang, ")}, {_step("whole", "")},
fences AS (SELECT o.lang, o.source, o.measure, (o.total * o.fence + {quality_rules.WIDER} * ((l.total * l.fence + {quality_rules.WIDER} * w.fence)
    / (l.total + {quality_rules.WIDER}))) / (o.total + {quality_rules.WIDER}) AS fence
  FROM own o JOIN langs l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN whole w ON o.measure = w.measure),
limits AS (SELECT lang, source, {", ".join(f"max(fence) FILTER (WHERE measure = '{m}') AS max_{m}" for m in _MEASURES)}
  FROM fences GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({" AND ".join(f"m_{m} <= max_{m}" for m in _MEASURES)}, false) AS kept
FROM measures m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# -- 11, fill in the middle ----------------------------------------------------


@registered(r"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) for k in range(0, 4)] AS h FROM cut),
placed AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
       WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (SELECT *, '<P>' || substr(t, 1, a) AS p, '<M>' || substr(t, a + 1, b - a) AS m, '<S>' || substr(t, b + 1) AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM pieces""")
def op11_displacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.restored(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


# -- 12, benchmark decontamination ---------------------------------------------

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@registered(f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS words FROM documents),
items AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS name, {_TERMS} AS words FROM benchmark),
sized AS (SELECT name, words, least({decontamination.WINDOW}, len(words)) AS w FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT name, w, array_to_string(words[i:i + w - 1], ' ') AS said
  FROM (SELECT *, unnest(range(1, len(words) - w + 2)) AS i FROM sized)),
places AS (SELECT rid, i, w, array_to_string(words[i:i + w - 1], ' ') AS said
  FROM (SELECT rid, words, w, unnest(range(1, len(words) - w + 2)) AS i FROM docs, (SELECT DISTINCT w FROM sized) WHERE len(words) >= w)),
found AS (SELECT rid, i, p.w, name FROM places p JOIN windows USING (w, said)),
hits AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + w)) AS pos FROM found) GROUP BY rid),
named AS (SELECT rid, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT rid, name FROM found) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)""")
def op12_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.array_distinct(F.transform("items", lambda i: i["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# -- 13, conversation repair ---------------------------------------------------

_CRC_STEP = "xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
#: Bit by bit: each byte of the text followed by seven zeros, as one list.
_CRC_SQL = f"""xor(list_reduce(list_concat([4294967295], flatten([[CAST(ord(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]
    for x in string_split(key, '')])), lambda c, b: {_CRC_STEP}), 4294967295)"""
_SAID = f"rtrim(text, {SPACE_CHARS})"
#: What a role may follow: state (the initial that stands last, or nothing), letter and role given, and next state.
_MOVES = "('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')"
_KEEPS = "(state IN ('', 's', 'a') AND initial = 'u') OR (state = '' AND initial = 's') OR (state = 'u' AND initial = 'a')"


def _inserted(given: str) -> str:
    """`given` (state, cost, audit, out) with no, one or two turns inserted, the best plan per state."""
    more = lambda t: f"SELECT s.conv_id, m.next AS state, s.cost + 3 AS cost, s.audit || 'I' AS audit, list_append(s.out, m.role || ':') AS out FROM {t} s JOIN moves m ON s.state = m.state"
    return f"""(WITH g AS ({given}), one AS ({more("g")}), two AS ({more("one")})
    SELECT conv_id, state, unnest(min(struct_pack(cost := cost, audit := audit, out := out))) FROM (FROM g UNION ALL FROM one UNION ALL FROM two) GROUP BY conv_id, state)"""


@registered(f"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT *, {_CRC_SQL} % 20 AS kind FROM keyed),
changed AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS time FROM kinds),
rows AS (SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time) AS pos,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS seen FROM changed),
faulty AS (SELECT *, {_SAID} = '' AS blank, {_SAID} <> '' AND seen > 1 AS duplicate,
  {_SAID} <> '' AND seen = 1 AND right({_SAID}, 1) NOT IN ('.', '!', '?') AS truncated,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM rows),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
  count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
  count(*) FILTER (WHERE illegal) AS illegal, max(pos) AS last FROM faulty GROUP BY conv_id),
moves(state, next, role) AS (VALUES {_MOVES}),
plans(conv_id, pos, state, cost, audit, out) AS (
  SELECT conv_id, CAST(0 AS BIGINT), state, cost, audit, out FROM {_inserted("SELECT DISTINCT conv_id, '' AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS out FROM rows")}
  UNION ALL
  SELECT conv_id, pos, state, cost, audit, out FROM (SELECT * FROM (
    WITH step AS (SELECT p.*, f.role, f.text, f.initial, f.blank OR f.duplicate AS lost, CASE WHEN f.truncated THEN 3 ELSE 0 END AS extra
      FROM plans p JOIN faulty f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = p.pos + 1),
    done AS (SELECT conv_id, pos + 1 AS pos, state, cost + 4 AS cost, audit || 'D' AS audit, out FROM step
      UNION ALL SELECT conv_id, pos + 1, initial, cost + extra, audit || 'K', list_append(out, role || ':' || text) FROM step WHERE NOT lost AND ({_KEEPS})
      UNION ALL SELECT conv_id, pos + 1, m.next, cost + 3 + extra, audit || 'R', list_append(out, m.role || ':' || text)
        FROM step s JOIN moves m ON s.state = m.state WHERE NOT lost),
    one AS (SELECT s.conv_id, pos, m.next AS state, cost + 3 AS cost, audit || 'I' AS audit, list_append(out, m.role || ':') AS out FROM done s JOIN moves m ON s.state = m.state),
    two AS (SELECT s.conv_id, pos, m.next AS state, cost + 3 AS cost, audit || 'I' AS audit, list_append(out, m.role || ':') AS out FROM one s JOIN moves m ON s.state = m.state)
    SELECT conv_id, pos, state, unnest(min(struct_pack(cost := cost, audit := audit, out := out)))
    FROM (FROM done UNION ALL FROM one UNION ALL FROM two) GROUP BY conv_id, pos, state))),
best AS (SELECT c.conv_id, min(struct_pack(cost := p.cost, audit := p.audit, out := p.out)) AS b FROM counted c
  JOIN plans p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.pos = c.last AND p.state IN ('', 'a') GROUP BY c.conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counted c ON i.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON i.conv_id IS NOT DISTINCT FROM best.conv_id""")
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    mended = conversation_repair.repair(turns, gone="gone")
    digest = F.sha2(conversation_repair.repaired_text(F.col("repaired")), 256).alias("repaired_sha256")
    return mended.select("conv_id", *conversation_repair.NUMBERS, "audit", digest)
