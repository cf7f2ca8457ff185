"""The pipeline against a plain Python version, stage by stage, and its edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import clashing, docs, edge_rows
from test_documents import plain_components, plain_print

import corpus_pipeline
from costflow.llm import line_dedup, mixing, quality_rules
from costflow.llm.queries import tokenizer_path

STAGE = dict(corpus_pipeline.STAGES)
SPACES = " \t\n\x0b\x0c\r"


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    n, chars = len(words), sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    measures = {
        "symbols": 1000 * symbols // max(chars, 1),
        "dup_lines": 1000 * (len(lines) - len(set(lines))) // max(len(lines), 1),
        "repeats": 1000 * len(repeated) // max(n, 1),
        "word_length": 100 * chars // max(n, 1),
    }
    return n, failed, measures


def plain_quality(rows):
    found = [(r, *plain_measures(r["text"] or "")) for r in rows]
    values = defaultdict(list)
    for r, n, _, measures in found:
        for m, v in measures.items() if n else ():
            v -= v % 2 ** max(len(bin(v)) - 2 - 10, 0)
            for group in ((r["lang"], r["source"]), (r["lang"],), ()):
                values[group, m].append(v)

    def fence(group, m):
        own = sorted(values[group, m])
        low, high = own[-(-len(own) // 4) - 1], own[-(-3 * len(own) // 4) - 1]
        mine = high + quality_rules.FENCE * max(high - low, quality_rules.MEASURES[m][1])
        return mine if not group else (len(own) * mine + quality_rules.WIDER * fence(group[:-1], m)) / (len(own) + quality_rules.WIDER)

    return [r for r, n, failed, measures in found if not failed and all(v <= fence((r["lang"], r["source"]), m) for m, v in measures.items())]


def plain_lines(rows):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(SPACES))
    held = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= line_dedup.MIN_CHARS:
                held[key(line)].add(r["doc_id"])
    common = {k: max(ids) for k, ids in held.items() if len(ids) >= line_dedup.MIN_DOCUMENTS}
    out = []
    for r in rows:
        kept = "\n".join(x for x in (r["text"] or "").split("\n") if common.get(key(x), r["doc_id"]) == r["doc_id"])
        out.append({**r, "text": kept, "n_chars": len(kept)})
    return out


def plain_dedup(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    roots = plain_components([plain_print(r["text"]) for r in rows])
    return [r for i, r in enumerate(rows) if roots[i] == i]


def plain_mix(rows):
    chars = Counter()
    for r in rows:
        chars[r["source"]] += len(r["text"])
    weight = {s: c**mixing.TEMPERATURE for s, c in chars.items()}
    out = []
    for r in rows:
        c = chars[r["source"]]
        rate = weight[r["source"]] / sum(weight.values()) * sum(chars.values()) / c if c else 0.0
        draws = max(math.ceil(rate / mixing.MAX_MEAN), 1)
        mean, copies = rate / draws, 0
        for j in range(draws):
            u = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}:{j + 1}".encode()).hexdigest()[:13], 16) / 16**13
            k, below = 0, math.exp(-mean)
            while u >= below and k <= mixing.STEPS:
                k += 1
                below += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean else 0.0
            copies += k
        out += [r] * copies
    return out


def known(rows):
    return Counter(tuple(sorted((k, v) for k, v in (r if isinstance(r, dict) else r.asDict()).items())) for r in rows)


@pytest.fixture(scope="module")
def fixture(spark):
    """Documents of the given table, with shared lines, near and exact copies and a hot source."""
    given = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = np.random.default_rng(9)
    shared = "This line is found in many of the documents, word for word, as licences are."
    rows = []
    for i, r in enumerate(given):
        text = r["text"] or ""
        if i % 4 == 0:
            text = f"{shared}\n{text}\n  {shared.upper()}"
        rows.append({**r, "text": text, "source": "hot" if i % 3 == 0 else r["source"]})
    for r in [x for x in rows if len((x["text"] or "").split()) > 300][:20]:
        words = r["text"].split(" ")
        words[int(rng.integers(len(words)))] = "changed"
        rows.append({**r, "doc_id": r["doc_id"] + 100_000, "text": " ".join(words)})
        rows.append({**r, "doc_id": r["doc_id"] + 200_000})
    return rows


def test_every_stage_against_plain_python(spark, fixture, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    plain, frame = fixture, spark.createDataFrame([tuple(r[c] for c in schema.names) for r in fixture], schema)
    sizes = [len(plain)]
    for name, step in (("quality_rules", plain_quality), ("line_dedup", plain_lines), ("simhash_near_dedup", plain_dedup), ("mixing", plain_mix)):
        plain = step(plain)
        frame = corpus_pipeline.written(STAGE[name](spark, frame, sf_dir), name)
        assert known(frame.collect()) == known(plain), name
        sizes.append(len(plain))
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] + 20 and sizes[4] > 0

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = STAGE["packing"](spark, frame, sf_dir).collect()
    tokens = Counter((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in plain)
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == tokens
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in tokens.items())


def test_stages_of_odd_rows(spark, sf_dir):
    odd = clashing(docs(spark, [*edge_rows(), *edge_rows()])).selectExpr("* EXCEPT (lang, source)", "CAST(NULL AS STRING) AS lang", "IF(doc_id = 4, NULL, 'a') AS source")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        assert name == "packing" or out.columns == odd.columns
        out.collect()
        assert stage(spark, odd.limit(0), sf_dir).collect() == []


def test_null_languages_and_sources_are_groups(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(80)), None if i % 2 else "en", None if i % 3 else "s", None) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert quality_rules.keep_good(frame).count() == 30
    assert {r.source for r in mixing.mix(frame).select("source").collect()} == {None, "s"}
