"""Fill-in-the-middle, benchmark decontamination and conversation repair against plain Python."""

import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, docs, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from costflow.llm import conversation_repair as cr
from costflow.llm import decontamination as dc
from costflow.llm import fill_in_middle as fim
from costflow.llm.queries import QUERIES

# -- 11 ------------------------------------------------------------------------

PIECES = ["<", "P", ">", "<P", "<P>", "<S>", "<M>", "S>", "é", "🙂", "日", "a", "\n", " "]


def plain_middle(doc_id, text):
    """(form, prefix, middle, output) by slicing."""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=20), st.integers(0, 10**6))
def test_scatter_and_gather_against_slices(texts, first):
    ids = list(range(first, first + len(texts)))
    cut = fim.transform(pa.array(texts, pa.string()), fim.draws(ids, "1"), fim.Rates())
    for i, text in enumerate(texts):
        form, prefix, middle, output = plain_middle(ids[i], text)
        assert (fim.FORMS[cut.form[i]], cut.output[i].as_py(), cut.n[i]) == (form, output, len(text))
        assert form == "plain" or (cut.prefix[i], cut.middle[i]) == (prefix, middle)
    assert fim.restore(cut.output, cut.form).to_pylist() == texts


def test_middle_of_edge_cases(spark, monkeypatch):
    rows = fim.restored(fim.fill_in_middle(clashing(docs(spark, edge_rows()))).selectExpr("*", "'x' AS restored")).collect()
    assert len(rows) == len(edge_rows())
    said = sorted((i is None, i or 0, t or "") for i, t in edge_rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.restored) for r in rows) == said
    assert all(r.n == len(r.restored) and (r.prefix_chars is None) == (r.form == "plain") for r in rows)
    assert fim.restored(fim.fill_in_middle(docs(spark, []))).collect() == []


def test_slices_of_a_batch_cover_it_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (0, 5, 30, 0, 1, 9, 0)])], ["text"])
    for most in (1, 6, 10, 1000):
        parts = list(fim.byte_slices(batch, "text", most))
        assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
        assert all(p.num_rows == 1 or p.column(0).nbytes >= 0 and sum(map(len, p.column(0).to_pylist())) <= most for p in parts)


# -- 12 ------------------------------------------------------------------------


def plain_words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_matches(text, items, window):
    """(n_words, hit positions, {item: longest}) by trying every place."""
    words, hit, longest = plain_words(text), set(), {}
    for name, said in items:
        own = plain_words(said)
        w = min(window, len(own))
        for p in range(len(own) - w + 1) if own else ():
            for at in range(len(words) - w + 1):
                if words[at : at + w] != own[p : p + w]:
                    continue
                hit.update(range(at, at + w))
                n = w
                while at + n < len(words) and p + n < len(own) and words[at + n] == own[p + n]:
                    n += 1
                longest[name or ""] = max(longest.get(name or "", 0), n)
    return len(words), hit, longest


ITEM = "item_id string, text string"


@pytest.mark.parametrize(("block_bytes", "shard_bytes"), [(1 << 20, 1 << 20), (60, 50)])
def test_matches_against_every_place(spark, block_bytes, shard_bytes):
    rng = np.random.default_rng(5)
    words = ["a", "b", "Cé", "日本", "d9", "x" * 70, "x" * 71, "longerthaneight"]
    said = lambda n: " ".join(rng.choice(words, n))
    items = [(str(k), said(int(rng.integers(1, 9)))) for k in range(12)] + [("12", ""), ("13", None), (None, "b b"), ("1", "a-b d9"), ("1", "a-b d9")]
    rows = list(enumerate([said(int(rng.integers(0, 25))) for _ in range(60)] + [None, "", "...", "A", "cÉ Cé"])) + [(0, "A, a; B"), (0, "A, a; B"), (None, "b B")]
    found = dc.matches(docs(spark, rows), spark.createDataFrame(items, ITEM), 3, block_bytes, shard_bytes).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [list(s) for s in r.spans], sorted({i.item_id: 0 for i in r.items})) for r in found)
    expected = []
    for doc_id, text in rows:
        n, hit, longest = plain_matches(text, items, 3)
        runs = []
        for at in sorted(hit):
            if runs and runs[-1][1] == at:
                runs[-1][1] += 1
            else:
                runs.append([at, at + 1])
        expected.append((doc_id is None, doc_id or 0, n, runs, sorted(longest)))
    assert got == sorted(expected)
    by_text = {(doc_id, len(plain_words(text))): plain_matches(text, items, 3)[2] for doc_id, text in rows if doc_id}
    for r in found:
        if r.doc_id:
            assert {i: max(x.longest for x in r.items if x.item_id == i) for i in {x.item_id for x in r.items}} == by_text[r.doc_id, r.n_words]
        assert r.n_hit == sum(b - a for a, b in r.spans)
        for i in r.items:  # the places are those of the words
            own = [plain_words(t) for name, t in items if (name or "") == i.item_id]
            text = next(plain_words(t) for d, t in rows if d == r.doc_id and len(plain_words(t)) == r.n_words)
            assert any(text[i.doc_start : i.doc_start + i.longest] == o[i.item_start : i.item_start + i.longest] for o in own)


def test_words_end_with_their_text():
    got = dc.words_of_texts(pa.array(["ab", "cd", "", "é", "ab", " ab", "AB."]))
    parts = [got.codes[a : b - 1].tolist() for a, b in zip(got.begins, got.begins[1:])]
    assert [len(p) for p in parts] == [1, 1, 0, 1, 1, 1, 1] and parts[0] == parts[4] == parts[5] == parts[6] != parts[1]
    assert not got.codes[got.begins[1:] - 1].any() and dc.words_of_texts(pa.array([], pa.string())).codes.tolist() == []


@pytest.mark.parametrize("largest", [3, 2**63])
def test_suffix_arrays_are_sorted(largest):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, largest, 400, dtype=np.uint64)
    codes[200:300] = codes[:100]
    array = dc.suffix_array(codes, 400)
    assert sorted(range(len(codes)), key=lambda i: codes[i:].tolist()) == array.tolist()


def test_affected_documents_go(spark):
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before it. {leak.upper()}! After"), (2, "one two three four five six seven eight nine"), (3, None), (None, leak), (4, leak.replace("six", "6"))]
    frame = clashing(docs(spark, rows))
    items = spark.createDataFrame([("7", leak)], ITEM)
    clean = dc.decontaminated(frame, items)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {2, 3, 4}
    assert dc.decontaminated(frame, items, block_bytes=1).count() == 3
    assert dc.decontaminated(frame, items.limit(0)).count() == len(rows) and dc.matches(frame.limit(0), items).collect() == []
    assert {r.n_hit for r in dc.matches(frame, items.limit(0)).collect()} == {0}


def test_edge_rows_of_the_search(spark):
    items = spark.createDataFrame([("1", "a b c"), ("2", None)], ITEM)
    got = dc.matches(clashing(docs(spark, edge_rows())), items).collect()
    assert len(got) == len(edge_rows()) and sorted(r.doc_id for r in got if r.n_hit) == [4, 4, 5]


# -- 13 ------------------------------------------------------------------------


def plain_cheapest(rows, found):
    """(cost, audit, rows after it) by trying every plan, the least as (cost, text)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    given = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @cache
    def best(i, last, inserted):
        plans = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 3:
            plans.append(step(3, "I", (given[last], ""), best(i, given[last][0], inserted + 1)))
        if i < len(rows):
            role, text = rows[i]
            plans.append(step(4, "D", None, best(i + 1, last, 0)))
            if found[i] not in ("blank", "duplicate"):
                extra = 3 * (found[i] == "truncated")
                plans.append(step(3 + extra, "R", (given[last], text), best(i + 1, given[last][0], 0)))
                if role[:1] and role[:1] in legal[last]:
                    plans.append(step(extra, "K", (role, text), best(i + 1, role[0], 0)))
        return min((p for p in plans if p), default=None)

    def step(cost, letter, row, rest):
        return rest and (cost + rest[0], letter + rest[1], ((row,) if row else ()) + rest[2])

    return best(0, "", 0)


TURNS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(-2, 6)), st.sampled_from(["user", "assistant", "system", "tool", "", " "]), st.sampled_from(["a.", "b?", "c", " ", "", "a.\n", "é!"])),
    max_size=9,
)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_repair_against_every_plan(turns):
    rows = [(role, text) for _, role, text in turns]
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired = cr.mended(turns)
    found = cr.faults(rows)
    for i, (role, text) in enumerate(rows):
        said = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not said else "duplicate" if rows[i] in rows[:i] else None if said[-1] in ".!?" else "truncated"
        assert found[i] == fault
    assert (cost, audit, tuple(repaired)) == plain_cheapest(rows, found)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0][:1] for r in repaired))
    numbers = [t for t, _, _ in turns if t is not None]
    assert gaps == (len(set(range(min(numbers), max(numbers) + 1)) - set(numbers)) if numbers else 0)
    assert illegal == sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))


def test_long_conversations_end(spark):
    turns = [(i, "user" if i % 3 else "assistant", f"said {i}.") for i in range(6_000)]
    *_, cost, audit, repaired = cr.mended(turns)
    assert len(repaired) % 2 == 0 and cost == 3 * (audit.count("I") + audit.count("R")) + 4 * audit.count("D")


def test_repair_of_edge_cases(spark):
    rows = [(1, 1, "user", "Hi."), (1, 0, "system", "Be."), (1, None, "user", " "), (1, 2, "assistant", "Yes"), (1, 2, "assistant", "Yes"), (None, None, None, None), (None, 3, "user", "é."), (2, 5, "x", "gone")]
    frame = spark.createDataFrame([(*r, r[0] == 2) for r in rows], "conv_id long, turn long, role string, text string, gone boolean").selectExpr("*", "'x' AS audit", "'y' AS cost", "'z' AS kind")
    got = {r.conv_id: r for r in cr.repair(frame, gone="gone").collect()}
    assert set(got) == {1, 2, None}
    assert (got[1].blank, got[1].duplicate, got[1].truncated, got[1].gaps, got[1].illegal) == (1, 1, 1, 0, 2) and got[1].audit == "DKKKD"
    assert (got[2].audit, got[2].repaired, got[2].cost, got[2].gaps) == ("", [], 0, 0)
    assert got[None].blank == 1 and [tuple(r) for r in got[None].repaired] in ([("user", "é."), ("assistant", "")], [])
    assert {r.conv_id: r.cost for r in cr.repair(frame).collect()}[2] > 0
    assert cr.repair(frame.limit(0)).collect() == []


def test_damage_against_plain_python(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    more = spark.createDataFrame([(None, 1, "user", "x."), (3, None, None, None), (10**6, None, "user", None)], "conv_id long, turn long, role string, text string")
    rows = turns.unionByName(more).collect()
    plain = {}
    for r in rows:
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (r.role, r.text))
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own = plain.setdefault(r.conv_id, [])
        own += [(r.turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {r.conv_id: r for r in cr.repair(cr.damaged(turns.unionByName(more)), gone="gone").collect()}
    assert set(got) == set(plain)
    for conv_id, own in plain.items():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        *numbers, audit, repaired = cr.mended(own)
        row = got[conv_id]
        assert ([row[c] for c in cr.NUMBERS], row.audit, [tuple(x) for x in row.repaired]) == (numbers, audit, repaired)


def test_query_columns(spark, sf_dir):
    assert QUERIES["op13_repair"](spark, sf_dir).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
