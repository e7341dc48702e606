"""Licences, token totals, archives, top-k, the registered queries beside their SQL, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import string
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402
from check_oracles import compare, tables_in  # noqa: E402

from wickline.llm import decontaminate, licenses, near_join, queries, severity, suffix_dedup, token_rollup, topk, warc  # noqa: E402
from wickline.session import fresh_path  # noqa: E402


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_twin(spark, sf, name):
    said = compare(queries.QUERIES[name](spark, sf), tables_in(sf), queries.ORACLES[name])
    assert said.startswith("ok "), said


def licences_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, sentence string, rule int")
    return {i: [] for i in range(len(texts))} | {
        i: [(r.licence, r.n_sentences) for r in sorted(rows, key=lambda r: r.first_sentence)]
        for i, rows in __import__("itertools").groupby(
            sorted(licenses.scan_licenses(docs).collect(), key=lambda r: r.doc_id), key=lambda r: r.doc_id)}


def test_licences(spark):
    s = licenses.SENTENCES
    mit = f"The MIT License\n\nCopyright (c) 2020 X\n\n{s['mit-grant']}:\n\n{s['mit-notice']}.\n\n{s['mit-as-is']}. {s['mit-liability']}."
    wrapped = s["mit-grant"].replace(" copies", "\n   copies").replace(" including", "\nincluding")
    texts = [mit, f"Foo.\nLICENSED under   CC BY-NC 4.0.\nbar", f"x\n{wrapped}:\ny", None, "", "no licence here",
             f"{s['bsd-grant']}: {s['bsd-source']}. {s['bsd-binary']}. {s['bsd-as-is']}.", f"{s['gpl3-short']}. " * 3, "word " * 200_000]
    got = licences_of(spark, texts)
    assert got[0] == [("MIT", 5)] and got[1] == [("CC-BY-NC-4.0", 1)] and got[2] == [("MIT", 1)]
    assert got[3] == got[4] == got[5] == got[8] == [] and got[6] == [("BSD-2-Clause", 4)] and got[7] == [("GPL-3.0-only", 1)] * 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan_licenses(empty).count() == 0


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * "])
def test_licences_wrapped_over_lines_and_in_comments(spark, mark):
    longest = {}
    for name, ids in licenses.RULES:
        longest[name] = max(longest.get(name, []), ids, key=len)
    wrap = lambda x: "\n".join(mark + line for line in textwrap.wrap(x, 72, break_on_hyphens=False))
    texts = [f"\n{mark.rstrip()}\n".join(wrap(licenses.SENTENCES[i] + ".") for i in ids) for ids in longest.values()]
    got = licences_of(spark, texts)
    assert [got[i] for i in range(len(texts))] == [[(name, len(ids))] for name, ids in longest.items()]


def changes(spark, rows):
    return token_rollup.signed(spark.createDataFrame(
        rows, "change string, source string, lang string, tokenizer string, old_tokens long, new_tokens long"))


def test_rollup_counts_batches_once(spark):
    rollup = token_rollup.TokenRollup(spark, fresh_path(spark, "rollup"))
    assert rollup.totals().count() == 0
    one = changes(spark, [("insert", "a", "en", "v1", None, 10), ("insert", "a", "en", "v1", None, 5), ("insert", None, "en", "v1", None, 1)])
    two = changes(spark, [("delete", "a", "en", "v1", 5, None), ("revise", "a", "en", "v1", 10, 12), ("delete", None, "en", "v1", 1, None)])
    assert rollup.commit("1", one) and not rollup.commit("1", one) and rollup.commit("2", two)
    want = [("a", "en", "v1", 1, 12)]
    assert [tuple(r) for r in rollup.totals().collect()] == want
    rollup.compact()
    assert not rollup.commit("2", two) and [tuple(r) for r in rollup.totals().collect()] == want
    assert rollup.commit("3", changes(spark, [("insert", "b", None, "v2", None, 7)])) and rollup.totals().count() == 2
    rollup.compact()
    assert rollup.totals().count() == 2


def test_unfinished_batch_is_written_anew(spark):
    path = fresh_path(spark, "rollup")
    rollup = token_rollup.TokenRollup(spark, path)
    rows = changes(spark, [("insert", "a", "en", "v1", None, 3)])
    rows.withColumn("tokens", F.col("tokens") * 9).write.parquet(f"{path}/batches/1")
    (Path(path) / "batches/1/_SUCCESS").unlink()
    assert rollup.totals().count() == 0 and rollup.commit("1", rows) and rollup.totals().first().tokens == 3
    with pytest.raises(Exception, match="no such change"):
        changes(spark, [("drop", "a", "en", "v1", 1, 1)]).collect()


def test_token_counts_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ranks = open(f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb").read()
    count = {"words": lambda t: len(t.split()), "byte_bpe_50k": lambda t: len(token_rollup._encoding(ranks).encode_ordinary(t))}
    first, want = {}, {}
    for r in docs:
        first[r.text or ""] = min(r.doc_id, first.get(r.text or "", r.doc_id))
    for r in docs:
        if r.doc_id == first[r.text or ""]:
            for name, f in count.items():
                total = want.setdefault((r.source, r.lang, name), [0, 0])
                total[0] += 1
                total[1] += f(__import__("re").sub(" +", " ", r.text or ""))
    got = {tuple(r)[:3]: list(tuple(r)[3:]) for r in queries.op2_token_counts(spark, sf).collect()}
    assert got == want


EVIL = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 4\r\n\r\nevil\r\n\r\n"


def pages_of(spark, htmls):
    return spark.createDataFrame([(i, f"http://x/{i}\r\nX: y", h, "x", 7) for i, h in htmls], "page_id long, url string, html string, digest string, first long")


@pytest.mark.parametrize("block", ["128m", "512"])
def test_archives_round_trip(spark, block):
    big = "ü<p>" * 60
    htmls = [(1, "a"), (2, None), (3, ""), (4, big), (9, big), (5, big + "!"), (6, EVIL), (7, f"xx{EVIL * 40}yy"), (8, f"{EVIL}{big}"),
             (10, "WARC/1.1\r\n" * 30), (11, "\r\n\r\n"), (12, "a"), (13, "k" * 20_000), (None, "null id " * 30), (14, f"xx{EVIL * 40}yy")]
    path = fresh_path(spark, "warc")
    warc.write_archives(pages_of(spark, htmls).coalesce(3), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
        rows = warc.read_archives(spark, path).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == len(htmls)
    for i, h in htmls:
        body = (h or "").encode()
        again = {9: 4, 14: 7}.get(i)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (
            len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", again)


def test_archives_empty_and_broken(spark):
    path = fresh_path(spark, "warc")
    warc.write_archives(pages_of(spark, [(1, "a")]).limit(0), path)
    assert warc.read_archives(spark, path).count() == 0
    warc.write_archives(pages_of(spark, [(1, "abcdef"), (2, "x")]).coalesce(1), f"{path}-2")
    whole = next(Path(f"{path}-2").glob("part-*"))
    broken = Path(f"{path}-3")
    broken.mkdir()
    (broken / "a.warc").write_bytes(whole.read_bytes()[:-9])
    with pytest.raises(ValueError):
        warc.read_archives(spark, str(broken))


def brute_top(rows, k):
    out = []
    for q, x in rows:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(y) == len(x))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(16_384, 2_048), (40, 2)])
def test_top_k_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "CANDIDATES", sizes[0])
    monkeypatch.setattr(topk, "QUERIES", sizes[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 8).tolist()) for i in range(300)] + [(300, [0] * 8), (301, [1] * 8), (350, [1, 2]), (351, [3, 4]), (400, [])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_top(rows, 5)
    assert topk.top_k(frame.limit(0), F.lit(True)).count() == 0 and topk.top_k(frame, F.lit(False)).count() == 0


def test_integer_vectors_leave_out_what_is_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [])]
    got = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.vec_id, r.vector) for r in got] == [(1, [128, -1]), (6, [])]
    twice = spark.createDataFrame([(0, [1, 1])] * 2 + [(1, [3, 3]), (2, [2, 2])], "vec_id long, vector array<long>").repartition(3)
    assert sorted(tuple(r) for r in topk.top_k(twice, F.col("vec_id") == 0).collect()) == [(0, 1, 1, 6), (0, 2, 2, 4)]
    big = [(0, [2 ** 40, 1]), (1, [2 ** 20, 3])]
    assert topk.top_k(spark.createDataFrame(big, "vec_id long, vector array<long>"), F.col("vec_id") == 0).first().score == 2 ** 60 + 3


def passages_in(text, n=51):
    """All runs of 51 words between ASCII white space, as they stand, and without the marks at their ends."""
    spans = [m.span() for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
    marks, out = string.punctuation, []
    for (start, end), (begin, stop) in zip(spans, spans[n - 1:]):
        first, last = text[start:end].lstrip(marks), text[begin:stop].rstrip(marks)
        inner = end - len(first) if first else start
        outer = begin + len(last) if last else stop
        out.append({text[i:j] for i in (start, inner) for j in (stop, outer)})
    return out


def test_pipeline_stages_follow_their_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, corpus_pipeline.run(spark, sf).collect()
    named = dict(corpus_pipeline.STAGES)
    clean = named["toxicity"](spark, docs, sf)
    flags = severity.grade(docs, severity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    assert clean.columns == columns and clean.count() == flags.where("not toxic").count()
    kept = named["near_dedup"](spark, clean, sf)
    want = {r.doc_id for r in near_join.near_components(clean, 80).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == columns
    cut = named["suffix_dedup"](spark, kept, sf)
    # A text changes if it holds a passage of 51 words or a byte string of 400 that stands twice, and no such passage is left.
    before, after = ({r.doc_id: r.text or "" for r in x.collect()} for x in (kept, cut))
    counts = collections.Counter(p for t in before.values() for found in passages_in(t) for p in found)
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(kept, 400).collect()}
    assert cut.columns == columns and any(n > 1 for n in counts.values())
    for i, text in before.items():
        twice = [p for found in passages_in(text) for p in found if counts[p] > 1]
        assert all(p not in after[i] for p in twice)
        assert (text != after[i]) == bool(twice or removed[i])
    fair = named["decontamination"](spark, cut, sf)
    bad = {r.doc_id for r in decontaminate.leaks(cut, spark.read.parquet(f"{sf}/benchmark.parquet"), 0.8, short=True).collect()}
    assert {r.doc_id for r in fair.collect()} == {r.doc_id for r in cut.collect()} - bad
    assert {r.doc_id for r in rows} == {r.doc_id for r in fair.collect()}
    texts = {r.doc_id: r.text for r in fair.collect()}
    assert all(r.decoded == (texts[r.doc_id] or "") for r in rows)


def test_pipeline_of_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(80)), "en", "s", 1) for i in range(20)]
    rows += [rows[3], (21, rows[3][1], None, None, None), (22, None, "en", "s", 0), (23, "", "en", "s", 0), (None, rows[4][1], "en", "s", 1), (None, None, None, None, None)]
    leaked = " ".join(word() for _ in range(80))
    rows += [(None, leaked, "en", "s", 1)]  # holds an item, and has no id
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, rows[5][1]), (2, leaked)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(i for i in got if i is not None) == [i for i in [*range(20), 22, 23] if i != 5] and got.count(None) == 2
