"""Operators over documents against plain Python, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from costflow.llm import chunking, line_dedup, mixing, neighbours, packing, quality_rules, sanitise, simhash
from costflow.llm.queries import QUERIES, tokenizer_path
from helpers import clashing, docs, edge_rows


@pytest.fixture(scope="module")
def edges(spark):
    return clashing(docs(spark, edge_rows()))


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


OPERATORS = {
    "chunking": chunking.fingerprints,
    "simhash": simhash.near_duplicates,
    "packing": lambda d: packing.packed_pieces(d, tokenizer_path()),
    "sanitise": sanitise.find_spans,
    "mixing": mixing.mix,
    "lines": line_dedup.drop_shared_lines,
    "rules": quality_rules.apply_rules,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_cases_and_empty_tables(edges, name):
    result = OPERATORS[name](edges)
    rows = result.collect()
    if name == "packing":
        assert sum(r.start == 0 for r in rows) == len(edge_rows())
    elif name != "mixing":
        assert len(rows) == len(edge_rows())
    assert OPERATORS[name](edges.limit(0)).collect() == []


# -- 1 -------------------------------------------------------------------------


def test_fingerprints_follow_the_next_document(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    order = sorted(texts, reverse=True)
    for i, doc_id in enumerate(order):
        own, following = texts[doc_id], texts[order[(i + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        row = rows[doc_id]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(own)
        assert row.fingerprint == chunking.encoded(chunking.chunk_set(own))
        assert row.near_edited == chunking.containment(chunking.decoded(row.fingerprint), chunking.decoded(row.edited_fingerprint))
    assert len(rows) == len(texts)


def plain_chunks(text):
    """Byte by byte: a chunk ends at a zero in the hash's upper bits, six before the normal size and four from it on."""
    data, h, start, chunks = text.encode(), 0, 0, {}

    def close(end):
        nonlocal start
        chunks[xxhash.xxh64_intdigest(data[start:end]) >> 24] = end - start
        start = end

    for i, byte in enumerate(data):
        h = ((h << 1) + int(chunking.GEAR[byte])) & 0xFFFFFFFF
        size = i + 1 - start
        if size >= 8 and h >> 26 == 0 or size >= 32 and h >> 28 == 0 or size == 128:
            close(i + 1)
    if start < len(data):
        close(len(data))
    return chunks


def plain_likeness(own, other):
    total = sum(own.values())
    return sum(n for d, n in own.items() if d in other) / total if total else float(not other)


def test_fingerprints_against_bytes_one_by_one(spark, texts, setting):
    """Also over a thousand partitions, where the ranges outnumber the documents."""
    order = sorted(texts, reverse=True)
    plain = {i: plain_chunks(texts[i]) for i in order}
    for partitions in ("4", "1000"):
        setting("spark.sql.shuffle.partitions", partitions)
        rows = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
        for i, doc_id in enumerate(order):
            row, following = rows[doc_id], order[(i + 1) % len(order)]
            assert chunking.decoded(row.fingerprint) == plain[doc_id]
            assert row.near_next == pytest.approx(plain_likeness(plain[doc_id], plain[following]))
            half = len(texts[doc_id]) // 2
            edited = plain_chunks(texts[doc_id][: len(texts[doc_id]) - half] + texts[following][:half])
            assert chunking.decoded(row.edited_fingerprint) == edited
            assert row.near_edited == pytest.approx(plain_likeness(plain[doc_id], edited))


def test_chunks_cover_the_text_and_resist_shifts():
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    cuts = chunking.boundaries(data)
    sizes = np.diff([0, *cuts])
    assert cuts[-1] == len(data) and sizes.max() <= chunking.MAX_SIZE and sizes[:-1].min() >= chunking.MIN_SIZE
    text = data.decode()
    assert chunking.containment(chunking.chunk_set(text), chunking.chunk_set("shifted " + text)) > 0.98
    h, expected = 0, []
    for b in data[:500]:
        h = ((h << 1) + int(chunking.GEAR[b])) & 0xFFFFFFFF
        expected.append(h)
    assert chunking.gear_hashes(np.frombuffer(data[:500], np.uint8)).tolist() == expected
    assert chunking.containment({}, {}) == 1.0 and chunking.containment({}, {1: 2}) == 0.0


# -- 2 -------------------------------------------------------------------------


def plain_print(text):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= distance).tolist():
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_against_all_pairs(spark, texts):
    rows = QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001").collect()
    ids = sorted(texts)
    prints = [plain_print(texts[i]) for i in ids]
    roots = dict(zip(ids, (ids[k] for k in plain_components(prints)), strict=True))
    assert {r.doc_id: r.component_id for r in rows} == roots
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in zip(ids, prints, strict=True)}


def test_dense_prints_link_like_all_pairs(spark):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(30):
            prints.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
    values = sorted(simhash.signed(p) for p in prints)
    table = spark.createDataFrame([(v,) for v in values], "print long")
    found = {r.print: r.root for r in simhash.link_components(table, 4).collect()}
    roots = plain_components([v & (2**64 - 1) for v in values])
    assert found == {v: values[r] for v, r in zip(values, roots, strict=True)}


def test_allocation_spends_all_units_at_the_least_cost():
    costs = [[0, 5, 9, 20], [0, 1, 2, 30], [0, 7, 8, 9]]
    assert simhash.allocate(costs, 3) == [0, 1, -1]


def test_one_of_each_keeps_clean_rows(spark, edges):
    kept = simhash.one_of_each(edges)
    assert kept.columns == edges.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 4: 1, 6: 1, 7: 1, None: 2})


# -- 4 -------------------------------------------------------------------------


def test_packing_against_whole_text_tokens(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = QUERIES["op4_packing"](spark, "/root/testdata/sf0.001").collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes()) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in pieces])
        assert [p.offset for p in pieces] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(by_sequence) <= 1 + sum(r.length for r in rows) // 4080


def test_word_ids_equal_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = ["<|endoftext|>a <|ENDOFTEXT|> x", "İstanbul ΣΑΣ ΌΣΟΣ. ﬁne Å naïve's don't x'S 日本語 नमस्ते, १२३ ½", "\x1c\x85 a b​c", "ß.ẞ,ẞ İ. ŉ! ΑΣ. Σ.", ""]
    for text, raw in zip(odd, packing.WordIds(tokenizer_path()).of(odd), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_fill_finds_the_best_subset():
    assert packing.fill({7: 2, 5: 1, 3: 3}, [7, 5, 3], 16) in ({7: 1, 3: 3}, {5: 1, 7: 1, 3: 1})  # 16 or 15
    chosen = packing.fill({7: 2, 5: 1, 3: 3}, [7, 5, 3], 16)
    assert sum(k * n for k, n in chosen.items()) == 16
    bins = packing.minimum_bin_slack([4, 4, 2, 6, 8, 8, 1], 8)
    assert sorted(i for b in bins for i in b) == list(range(7)) and len(bins) == 5


# -- 5 -------------------------------------------------------------------------


def test_spans_count_code_points_and_survive_long_runs(spark):
    said = "🙂 é a@b.c.d, 1.2.3.256 1.2.3.255 card 4111 1111 1111 1111 +1 (555) 123-4567 x"
    rows = docs(spark, [(1, said), (2, "1 " * 40_000), (3, "a@b" + ".c" * 40_000), (4, "a.b" * 20_000)])
    found = {r.doc_id: r.spans for r in sanitise.find_spans(rows).collect()}
    cut = {s.kind: said[s.start : s.end] for s in found[1]}
    assert cut == {"email": "a@b.c.d", "ip": "1.2.3.255", "card": "4111 1111 1111 1111", "phone": "+1 (555) 123-4567"}
    assert [len(found[i]) for i in (2, 3, 4)] == [0, 1, 0]


def plain_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    def good(kind, said):
        digits = re.sub("[^0-9]", "", said)
        if kind == "ip":
            return all(int(p) <= 255 for p in said.split("."))
        return kind == "email" or (16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15)

    return [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if good(k, m[0])]


def test_base_spans_against_the_plain_patterns(spark):
    rng = np.random.default_rng(11)
    pieces = ["a@b.c", "_", ".", "@", "-", " ", "1", "12", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "+1 555 123 4567", "é", "🙂", "x", "\n"]
    said = ["".join(rng.choice(pieces, rng.integers(1, 60))) for _ in range(400)]
    said += ["mail a@b.cd, 🙂 9.9.9.9 " * 3_000, "a" * 300_000 + " a@b.c", "7" * 300_000 + " . 1.1.1.1"]
    rows = docs(spark, list(enumerate(said)))
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in sanitise.base_spans(rows).collect()}
    for i, text in enumerate(said[:-2]):
        assert found[i] == plain_spans(text), text
    assert [len(found[len(said) - k]) for k in (2, 1)] == [1, 1]


def test_terms_that_only_occur_with_an_entity_are_hidden(spark):
    rows = [(i, "Zephyrine writes to z@mail.org about common things") for i in range(2)]
    rows += [(i, f"common things happen to everyone who writes about them {i}") for i in range(2, 40)]  # copies are one text, and two texts tell nothing
    clean = {r.doc_id: r.clean_text for r in sanitise.sanitised(docs(spark, rows)).collect()}
    assert clean[0] == " writes to <EMAIL> about common things" and clean[5] == rows[5][1]


def test_terms_are_hidden_in_the_whole_text_of_an_entity(spark):
    far = "common things happen to everyone who writes about them " * 3
    rows = [(i, f"Zephyrine Zephyrine {far}z@mail.org {far}zephyrine") for i in range(2)]
    rows += [(i, far + str(i)) for i in range(2, 40)]
    clean = {r.doc_id: r.clean_text for r in sanitise.sanitised(docs(spark, rows)).collect()}
    assert clean[0] == f"  {far}<EMAIL> {far}" and clean[5] == rows[5][1]


def plain_terms(said):
    """{text: [(start, end, disclosed)]} by plain counting over distinct texts."""
    texts = set(said)
    held, words, where = {}, {}, {}
    for text in texts:
        base = plain_spans(text)
        held[text] = {(k, text[a:b].lower()) for k, a, b in base}
        places = [(m.start(), m.end(), m[0].lower()) for m in re.finditer("[A-Za-zé]{4,}", text)]
        words[text] = {w for _, _, w in places}
        where[text] = [(a, b, w) for a, b, w in places if not any(x < b and y > a for _, x, y in base)]
    n, n_term = len(texts), Counter(w for t in texts for w in words[t])
    n_entity = Counter(e for t in texts for e in held[t])
    n_pair = Counter((e, w) for t in texts for e in held[t] for w in {w for _, _, w in where[t]})

    everywhere = " \n".join(texts)
    small = set(re.findall("[a-zé]{4,}", re.sub("[A-Z][A-Za-zé]*", " ", everywhere)))
    inside = {w.lower() for w in re.findall("(?<=[A-Za-zé0-9,;:] )[A-Z][A-Za-zé]{3,}", everywhere)}
    names = {w: w in inside and w not in small for w in n_term}
    alike = Counter((n_term[w], names[w]) for w in n_term)

    def disclosed(e, w):
        p, k, t = n_entity[e] / n, n_pair[e, w], n_term[w]
        if p == 1:
            return 0.0
        chance = min(1.0, (1 if k == t else (np.e * t / k) ** k) * p**k) * alike[t, names[w]]
        return np.log2((k + sanitise.PRIOR * p) / (t + sanitise.PRIOR) / p) / -np.log2(p) if names[w] or chance <= sanitise.CHANCE else 0.0

    told = {t: [(a, b, max((disclosed(e, w) for e in held[t]), default=0.0)) for a, b, w in where[t]] for t in texts}
    return {t: sorted(x for x in told[t] if x[2] >= sanitise.GENERALISE) for t in texts}


def test_terms_against_plain_counting(spark):
    rng = np.random.default_rng(8)
    pieces = [*(f"{a}{b}word" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"), *["the", "common", "Common", "things"] * 12, *(f"q{k}@b.cd" for k in range(20)), "9.8.7.6", "x.name@mail.org"]
    said = [" ".join(rng.choice(pieces, rng.integers(1, 60))) for _ in range(150)]
    said += [f"the person{c} and Person{c} of z{c}@b.cd {x}" for c in "abcdefgh" for x in ("once", "again")]
    said += [said[0]] * 5 + ["Solitary Quixote is at once@only.org", "é nothing here"]
    expected = plain_terms(said)
    assert sum(map(len, expected.values())) > 20
    for row in sanitise.find_spans(docs(spark, list(enumerate(said)))).collect():
        found = [(s.start, s.end, s.disclosed) for s in row.spans if s.kind == "term"]
        assert [x[:2] for x in found] == [x[:2] for x in expected[said[row.doc_id]]], said[row.doc_id]
        assert np.allclose([x[2] for x in found], [x[2] for x in expected[said[row.doc_id]]])
    assert any(a == 0 for a, _, _ in expected[said[-2]])


def test_names_go_and_words_stay(spark):
    """Sentences of words of every frequency; a third of the texts names a person, mostly one who is in no other."""
    rng = np.random.default_rng(21)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(4, 9)))
    vocabulary = [word() for _ in range(30_000)]
    weights = 1 / np.arange(1, 30_001)
    weights /= weights.sum()
    rows, planted, others, base = [], [], [], set()
    for i in range(1500):
        words = [vocabulary[k] for k in rng.choice(30_000, 120, p=weights)]
        sentences = [" ".join(words[k : k + 12]).capitalize() + "." for k in range(0, 120, 12)]
        if i % 3 == 0:
            person = i // 6 if i % 6 else i // 60  # some are in several texts
            name = "Q" + "".join(chr(97 + int(d)) for d in f"{person:05d}") + "ix"
            sentences.insert(4, f"They met {name} and wrote to {name.lower()[:3]}{person}@mail.org about it.")
            base.add(i)
            planted.append((i, name.lower()))
        rows.append((i, " ".join(sentences)))
    found = {r.doc_id: r.spans for r in sanitise.find_spans(docs(spark, rows)).collect()}
    hidden = {i: {rows[i][1][s.start : s.end].lower() for s in found[i] if s.kind == "term"} for i in base}
    caught = np.mean([name in hidden[i] for i, name in planted])
    names = {name for _, name in planted}
    for i in base:
        others += [w in hidden[i] for w in re.findall("[a-z]{4,}", rows[i][1].lower()) if w not in names and w != "mail"]
    assert caught >= 0.9 and np.mean(others) <= 0.02, (caught, np.mean(others))


def test_many_entities_and_terms_of_one_text_end(spark):
    many = " ".join(f"a{k}@b{k}.org word{'x' * (k % 7)}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}" for k in range(20_000))
    rows = docs(spark, [(1, many), (2, "plain words of another text"), (3, many + " a0@b0.org")])
    assert {r.doc_id: sum(s.kind == "email" for s in r.spans) for r in sanitise.find_spans(rows).collect()} == {1: 20_000, 2: 0, 3: 20_001}


# -- 6 -------------------------------------------------------------------------


def test_neighbours_tell_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = QUERIES["op6_neighbours"](spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_votes_against_every_neighbour():
    rng = np.random.default_rng(6)
    n = 60
    counts = rng.integers(0, 3, (n, neighbours.TERMS))
    counts[:20] = counts[20:40]  # ties
    counts[-1] = 0
    idf = rng.random(neighbours.TERMS).astype(np.float32)
    basis = rng.normal(size=(neighbours.TERMS, 8)).astype(np.float32)
    labels = rng.integers(0, 2, n).astype(float)
    empty = neighbours.Model(idf, basis, np.zeros((0, 8), np.float32), labels)
    vectors = empty.latent(counts)
    scores = neighbours.Model(idf, basis, vectors, labels).scores(counts)
    for i in range(n):
        row = np.log1p(counts[i]) * idf
        row[neighbours.HASHED :] *= neighbours.LAG_WEIGHT
        place = row / max(np.linalg.norm(row), 1e-12) @ basis
        place = place / max(np.linalg.norm(place), 1e-12)
        near = sorted(((float(sum(a * b for a, b in zip(place, v, strict=True))), k) for k, v in enumerate(vectors)), reverse=True)
        least = near[neighbours.NEIGHBOURS - 1][0]
        votes = [(max(c, 0) ** neighbours.SHARPNESS, labels[k]) for c, k in near if c >= least - neighbours.TIE]
        total = sum(w for w, _ in votes)
        expected = sum(w * y for w, y in votes) / total if counts[i].any() else labels.mean()
        assert scores[i] == pytest.approx(expected, abs=1e-3)


def test_a_labelled_text_is_its_own_neighbour_however_long(spark):
    long = "abc abd " * 60_000  # counts over sixteen bits
    rows = docs(spark, [(1, long), (2, long), (3, "xyz xyw " * 10)])
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    model = neighbours.fit(rows, labels)
    text = neighbours.term_counts(long)
    assert model.latent(text[None]) @ model.vectors.T == pytest.approx(np.array([[1, 0]]) if model.labels[0] else np.array([[0, 1]]), abs=0.05)


def test_neighbours_edge_cases(spark, edges):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    model = neighbours.fit(edges, labels)
    assert len(neighbours.score(edges, model).collect()) == len(edge_rows())
    nothing = neighbours.fit(edges.limit(0), labels.limit(0))
    assert {r.score for r in neighbours.score(edges, nothing).collect()} == {0.5}
    assert neighbours.score(edges.limit(0), model).collect() == []


# -- 7 -------------------------------------------------------------------------


def test_large_rates_have_no_upper_bound(spark):
    rows = spark.createDataFrame([(i, "x" * 10, "en", "big" if i < 500 else "small", 10) for i in range(502)], "doc_id long, text string, lang string, source string, n_chars long")
    copies = mixing.mix(rows, weights={"big": 0.5, "small": 0.5}).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in copies}
    assert 200 < n["small"] < 300 and 200 < n["big"] < 300


def test_the_order_is_by_position_and_repeatable(edges):
    first = [r.position for r in mixing.mix(edges).collect()]
    assert first == sorted(first) and first == [r.position for r in mixing.mix(edges).collect()]


def test_fences_move_smoothly_with_the_size_of_a_group(spark):
    """Two groups of 30 and 300 that differ from the corpus lean to their own values by their size."""
    rng = np.random.default_rng(4)
    rows = [("en", "web", int(v)) for v in rng.integers(0, 20, 5_000)]
    rows += [("en", "forum", int(v)) for v in rng.integers(500, 520, 300)] + [("de", "forum", int(v)) for v in rng.integers(500, 520, 30)]
    rows += [(None, None, 5)]
    frame = spark.createDataFrame(rows, "lang string, source string, symbols long").selectExpr("*", "0L AS dup_lines", "0L AS repeats", "500L AS word_length", "10L AS n_words")
    fences = {(r.lang, r.source): r.max_symbols for r in quality_rules.thresholds(quality_rules.sketches(frame)).collect()}

    def plain(values):
        ordered = sorted(values)
        low, high = (ordered[-(-k * len(ordered) // 4) - 1] for k in (1, 3))
        return high + quality_rules.FENCE * max(high - low, quality_rules.MEASURES["symbols"][1])

    def leaned(keep_own, wider):
        own = [v for row in rows if keep_own(row) for v in row[2:]]
        return (len(own) * plain(own) + quality_rules.WIDER * wider) / (len(own) + quality_rules.WIDER)

    whole = plain([v for *_, v in rows])
    for lang, source in {row[:2] for row in rows}:
        expected = leaned(lambda row: row[:2] == (lang, source), leaned(lambda row: row[0] == lang, whole))
        assert fences[lang, source] == pytest.approx(expected)
    assert fences["en", "web"] < 150 < fences["de", "forum"] < 400 < fences["en", "forum"]


# -- 9, 10 ---------------------------------------------------------------------


def test_shared_lines_stay_in_the_largest_document(spark):
    line = "This very line is found in a good number of documents é."
    rows = [(i, f"own {i}\n  {line.upper() if i == 2 else line}\t\n{line}") for i in range(5)] + [(9, "short\nshort")]
    kept = {r.row.doc_id: r for r in line_dedup.drop_shared_lines(docs(spark, rows)).collect()}
    # Only A-Z fold, so document 2 with É holds the same key only in its last line.
    assert [kept[i].n_dropped for i in range(5)] == [2, 2, 1, 2, 0]
    assert kept[0].kept_text == "own 0" and kept[9].kept_text == "short\nshort"


def test_rules_drop_what_stands_out(spark):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words, 80))) for i in range(150)]
    rows += [(900, " ".join(w + "#%&" for w in rng.choice(words, 80))), (901, "same words again " * 40), (902, "few words")]
    kept = {r.row.doc_id if "row" in r else r.doc_id: r for r in quality_rules.apply_rules(docs(spark, rows)).collect()}
    assert all(kept[i].kept for i in range(150))
    assert not kept[900].base_failed and not kept[900].kept
    assert kept[901].base_failed and kept[901].n_repeat_words == 120 and kept[902].base_failed
    assert {r.doc_id for r in quality_rules.keep_good(clashing(docs(spark, rows))).collect()} == set(range(150))
    assert quality_rules.keep_good(docs(spark, [])).columns == ["doc_id", "text", "lang", "source", "n_chars"]
