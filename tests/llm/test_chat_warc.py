"""Templates and conversations, archives, and the pipeline."""

import gzip
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

import corpus_pipeline
from costflow.llm import chat, template, warc
from costflow.llm.template import TemplateError, compile_template

TEXTS = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "/INST]", "x", "\n", "é🙂"])).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<s>[INST]\\"]), TEXTS)))
def test_formatting_is_reversible(turns):
    render = compile_template(chat.TEMPLATE, {"escape": chat.escape})
    text, spans = render({"messages": [{"role": r, "text": t} for r, t in turns]})
    assert chat.read_back(text, spans) == (turns, "".join(t for r, t in turns if r == "assistant"))


def test_language():
    source = "{% if 1 + 1 == 2 %}a{% else %}b{% endif %}{{ 'x' ~ 3 * 2 }}{% for i in xs %}{{ loop.index }}{{ i.k if loop.last else '-' }}{% endfor %}{% set z = xs|length %}{{ z }}"
    assert compile_template(source)({"xs": [{"k": 1}, {"k": 7}]}) == ("ax61-272", [])
    folded = template.fold_body(template.parse("{% if not true %}b{% endif %}{{ 'x' ~ 3 * 2 }}y", template.FILTERS), template.FILTERS)
    assert folded == (template.Output(template.Const("x6y")),)
    assert compile_template("{{ x.__class__ }}{{ x['__len__'] }}")({"x": "s"}) == ("", [])


@pytest.mark.parametrize("bad", ["{% if a %}", "{% endfor %}", "{{ f(1) }}", "{{ 1 + }}", "{{ a|open }}", "{% import os %}", "{{ ; }}"])
def test_bad_templates_are_refused(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "b"), (None, None, None, "x"), (2, 1, "user", "[INST]")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS loss_spans")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    assert set(got) == {1, 2, None} and got[1].n_turns == 3 and got[1].loss_chars == 2
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.format_conversations(turns.limit(0)).collect() == []


def test_archives(spark, tmp_path):
    same, small = "é" * 600, "s" * 999
    rows = [(1, "http://a/ b\r\n", same), (2, None, same), (3, "u", same), (3, "u", same), (4, "u", small), (5, "u", small), (6, "u", None), (None, "u", same), (None, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS original")
    index = warc.write_archives(pages, str(tmp_path))
    got = warc.read_records(index).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.page_id not in (3, None)) == [
        (1, "revisit", 3), (2, "revisit", 3), (4, "response", None), (5, "response", None), (6, "response", None)]
    assert [r.record_type for r in got if r.page_id == 3] == ["response"] * 2
    assert {(r.record_type, r.refers_to) for r in got if r.page_id is None} == {("revisit", 3), ("response", None)}
    assert all(r.payload_bytes == 1200 and r.payload_digest == hashlib.sha1(same.encode()).hexdigest() for r in got if r.page_id in (1, 2, 3))
    assert all(bytes(r.payload).decode() == (same if r.page_id == 3 else small) for r in got if r.page_id in (3, 4, 5))
    for file in tmp_path.iterdir():
        if file.name.endswith(".warc.gz"):
            assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")
    some = index.where("page_id = 4")
    assert [r.page_id for r in warc.read_records(some).collect()] == [4]
    assert warc.read_records(warc.write_archives(pages.limit(0), str(tmp_path))).collect() == []


def test_a_changed_payload_is_refused():
    digest = hashlib.sha1(b"payload").hexdigest()
    good = warc.record(1, "u", b"payload", digest, None, False, "2000-01-01T00:00:00Z")
    assert warc.parse(good)["payload_bytes"] == 7 and warc.parse(good)["payload_digest"] == digest
    for bad in (good.replace(b"payload\r\n", b"paxload\r\n"), good.replace(b"payload\r\n\r\n", b"payloa")):
        with pytest.raises(ValueError, match="was read"):
            warc.parse(bad)
    revisit = warc.record(2, None, b"payload", digest, 1, True, "2000-01-01T00:00:00Z")
    assert warc.parse(revisit)["payload"] is None and warc.parse(revisit)["payload_bytes"] == 7


def test_ranges_join_over_small_gaps():
    gap, most = warc.GAP_BYTES, warc.READ_BYTES
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 20 + gap + 1, 5), ("b", 0, most), ("b", most, 1)]
    assert list(warc.coalesced(rows)) == [("a", 0, 20, 2), ("a", 21 + gap, 26 + gap, 1), ("b", 0, most, 1), ("b", most, most + 1, 1)]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == columns
        seen.append(kept.count())
    assert seen[0] > seen[1] == seen[2] >= seen[3] > 0
    tokens = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert tokens.where("start = 0").count() == seen[4]
    assert corpus_pipeline.run(spark, sf_dir).count() == tokens.count()
