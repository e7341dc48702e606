"""Near-duplicate components, repeat removal and decontamination against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wickline.llm import near_join, passages, queries, suffix_dedup
from wickline.llm.components import components
from wickline.llm.decontaminate import fingerprint, leaks
from wickline.llm.near_join import chunk_keys, near_components
from wickline.llm.suffix_dedup import remove_repeats, repeated_windows

WORDS = [f"w{i}" for i in range(400)]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, k):
    words = text.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [text_of(rng, 150) for _ in range(30)]
    base = text_of(rng, 200)
    texts += [edited(rng, base, k % 5) for k in range(40)]  # near copies, some beyond the threshold of each other
    texts += [texts[0]] * 8 + [None, "", "  \t\n", "one two", "One  TWO", "a b c d e", "x" * 5000, "ÄÖ ü " * 300, "ab " * 3000]
    passage = text_of(rng, 120)
    texts += [f"{text_of(rng, 30)} {passage} {text_of(rng, 20)}" for _ in range(12)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", i, 1) for i, t in rows], "doc_id long, text string, signature string, key long, n_shingles int").repartition(5)


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows, percent=85):
    sets = {i: sets_of(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("block", [2000, 7])
def test_near_components_equal_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    got = near_components(docs_of(spark, rows)).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    assert len({c for _, c, _ in want.values()}) < len(want) - 20


def test_near_dedup_stage_links_at_80(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = text_of(rng, 200)
        texts += [base, *(edited(rng, base, k) for k in (3, 4, 5))]
    pairs = list(enumerate(texts))
    want, stricter = brute_components(pairs, 80), brute_components(pairs, 85)
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_components(docs, 80).collect()}
    assert got == want and {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {i for i, w in want.items() if w[2]}
    assert sum(w[2] for w in want.values()) + 5 < sum(w[2] for w in stricter.values())


@pytest.mark.parametrize("held", [1 << 20, 300])
def test_look_alikes_below_the_threshold_give_no_pair_rows(spark, monkeypatch, held):
    """Members of one key that never link, with a few that do, which only the last round finds."""
    monkeypatch.setattr(near_join, "BLOCK", 25)
    monkeypatch.setattr(near_join, "BLOCK_SHINGLES", held)
    made, settled = {}, near_join.settled
    monkeypatch.setattr(near_join, "settled", lambda df, label: made.setdefault((label, len(made)), settled(df, label)))
    monkeypatch.setattr(near_join, "discard", lambda *_: None)
    rng = random.Random(11)
    base = text_of(rng, 120)
    texts = [edited(rng, base, 4) for _ in range(70)]
    texts += [edited(rng, t, 1) for t in texts[:15]]
    pairs = list(enumerate(texts))
    want = brute_components(pairs, 85)
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_components(docs).collect()} == want
    counts = {name: df.count() for (name, _), df in made.items() if name in ("meeting", "links")}
    assert 30 < sum(w[2] for w in want.values()) and counts["meeting"] <= 2 * near_join.INDEXED * len(texts)


def test_keys_and_distance_follow_the_percent():
    assert near_join.reach(80) == (10, 48) and near_join.reach(85) == near_join.reach(95) == (near_join.CHUNKS, 40)


def test_near_components_of_an_empty_table(spark):
    assert near_components(docs_of(spark, [(1, "a")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        near_components(docs_of(spark, [(1, "a")]), 50)


def test_chunk_keys_find_every_pair_in_the_distance():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 16, (300, near_join.VALUES)).astype(np.uint16)
    two = one.copy()
    for row in two:
        row[rng.choice(near_join.INDEXED, 13, replace=False)] ^= 1
    assert (chunk_keys(one) == chunk_keys(two)).any(axis=1).all()


def test_known_texts_of_equal_polynomial_hashes_stay_apart(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    swapped = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, swapped), (3, word)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_components(docs).collect()} == {1: 1, 2: 2, 3: 1}
    rest = " ".join(f"v{i}" for i in range(50))  # a passage of 51 words with the long one, which differs
    rows = spark.createDataFrame([(1, f"{word} {rest}"), (2, f"{swapped} {rest}")], "doc_id long, text string")
    assert all(r.n_removed == 0 for r in remove_repeats(rows, 1999, words=51).collect())


def test_components_of_a_path_a_hub_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(21)) and all(got[i] == 100 for i in range(100, 160)) and got[202] == 200
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_repeats(texts, width):
    starts = Counter(t[p:p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if starts[t[p:p + width]] > 1:
                gone[p:p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [20_000, 2])
def test_repeats_equal_brute_force(spark, rows, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_STRINGS", most)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in remove_repeats(docs_of(spark, rows), 150).collect())
    want = brute_repeats([(t or "").encode() for _, t in rows], 150)
    assert got == sorted((i is None, i or 0, *w) for (i, _), w in zip(rows, want))
    assert sum(w[1] > 0 for w in want) > 40


def test_repeats_keep_whole_characters_and_columns(spark):
    both = "ü" * 300
    docs = spark.createDataFrame([(1, "a" + both, "s", 301), (2, "b" + both, "s", 301), (3, None, "t", None)], "doc_id long, text string, spans string, n_chars long")
    got = {r.doc_id: r for r in remove_repeats(docs, 400, whole_characters=True, keep=True).collect()}
    assert (got[1].text, got[1].n_chars, got[1].spans) == ("a", 1, "s") and got[3].text is None
    assert remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs, 50)


def test_column_wise_order_finds_windows_of_one_group_only():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(60)]
    group = np.repeat([1, 2, 3], 20)
    flags = repeated_windows(group, texts, np.zeros(60, np.int64), np.full(60, 8), 5)
    for i, t in enumerate(texts):
        for p in range(8):
            assert flags[i, p] == any(j != i and group[j] == group[i] and u[p:p + 5] == t[p:p + 5] for j, u in enumerate(texts))


def brute_passages(texts, words):
    """The texts without windows of so many words, with or without outer marks, that occur at another place."""
    places = [[] for _ in texts]
    for i, t in enumerate(texts):
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        inner = [(a + (m.start() if (m := re.search(rb"[A-Za-z0-9\x00-\x1f\x7f-\xff]", t[a:b])) else 0),
                  a + (len(t[a:b].rstrip(MARKS)) or b - a)) for a, b in spans]
        for k in range(len(spans) - words + 1):
            last = k + words - 1
            places[i] += {(a, b) for a in (spans[k][0], inner[k][0]) for b in (spans[last][1], inner[last][1])}
    counts = Counter(t[a:b] for t, found in zip(texts, places) for a, b in found)
    out = []
    for t, found in zip(texts, places):
        gone = bytearray(len(t))
        for a, b in found:
            if counts[t[a:b]] > 1:
                gone[a:b] = b"\1" * (b - a)
        out.append(bytes(c for c, g in zip(t, gone) if not g))
    return out


MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def test_pipeline_removes_passages_of_more_than_fifty_words(spark):
    rng = random.Random(4)
    filler = iter(range(10 ** 6))
    fresh = lambda n: " ".join(f"q{next(filler)}" for _ in range(n))
    passages = {n: " ".join(rng.choice(["a", "of", "the", "tree", "river", "ü"]) for _ in range(n)) for n in (50, 51, 52, 55, 60)}
    assert all(len(p.encode()) < 400 for p in passages.values())
    texts = [f"{fresh(30)} {p} {fresh(20)}" for p in passages.values() for _ in range(3)]
    texts += [f"{fresh(5)} (\"{passages[51]}.\") {fresh(5)}", passages[55], "", "- " * 60, f"{fresh(9)} {'x ' * 120}", None, "ab\n" * 51]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    want = brute_passages([(t or "").encode() for t in texts], 51)
    assert {i: (t or "").encode() for i, t in got.items()} == dict(enumerate(want)) and got[len(texts) - 2] is None
    assert all(passages[50] in got[i] for i in range(3)) and not any(p in got[i] for i in got for n, p in passages.items() if n > 50 and got[i])


def test_op4_text_is_without_short_passages_and_its_digests_follow_the_strings(spark, tmp_path):
    rng = random.Random(6)
    filler = iter(range(10 ** 6))
    fresh = lambda n: " ".join(f"z{next(filler)}" for _ in range(n))
    passages = {n: " ".join(rng.choice(["a", "of", "the", "tree", "river", "ü"]) for _ in range(n)) for n in (50, 51, 60, 200)}
    texts = [f"{fresh(30)} {p} {fresh(20)}" for p in passages.values() for _ in range(3)] + [passages[60], None, "", f"é{'x ' * 90}"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    raw = [(t or "").encode() for t in texts]
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for _, r in sorted(got.items())] == brute_repeats(raw, 400)
    want = brute_passages(raw, 51)
    long = range(9, 12)  # byte strings of 400 as well, which take equal bytes around them along
    assert all((got[i].text or "").encode() == want[i] for i in range(len(texts)) if i not in long) and got[len(texts) - 3].text is None
    assert all(got[i].n_removed >= len(passages[200].encode()) and passages[200] not in got[i].text for i in long)
    assert got[3].n_removed == 0 and passages[51] not in got[3].text and passages[50] in got[0].text


def test_equal_contexts_are_counted_once_and_rows_that_repeat_get_no_more_spans(spark):
    rng = random.Random(8)
    shared = text_of(rng, 300)
    rows = [(i, i, shared) for i in range(50)] + [(99, 99, shared + " end")] * 40
    texts = spark.createDataFrame(rows, "row_a long, row_b long, text string")
    spans = passages.repeated_passages(texts, 51).collect()
    assert all({b for r in spans if r.row_a == i for b in range(r.begin, r.end)} == set(range(len(shared))) for i in range(50))
    docs = spark.createDataFrame([(7, shared)] * 40, "doc_id long, text string")
    assert {r.text for r in remove_repeats(docs, 400, keep=True, words=51).collect()} == {""}


def test_workers_hash_a_batch_in_little_memory():
    rng = random.Random(9)
    texts = [text_of(rng, 2500).encode().decode() for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(range(200)), pa.array(texts)], names=["a", "b", "text"])
    for work in (lambda: sum(b.num_rows for b in passages._contexts(iter([batch]), 51)),
                 lambda: sum(b.num_rows for b in suffix_dedup._scan(iter([batch]), 400))):
        tracemalloc.start()
        assert work() > 0
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6


def brute_leaks(docs, items, least):
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for item, t in items:
        w = cut(t)
        g = min(len(w), 5)
        if not g:
            continue
        want = Counter(tuple(w[i:i + g]) for i in range(len(w) - g + 1))
        for doc, text in docs:
            d = cut(text)
            for s in range(len(d) - len(w) + 1):
                own = Counter(tuple(d[i:i + g]) for i in range(s, s + len(w) - g + 1))
                j = sum((want & own).values()) / sum((want | own).values())
                if j >= least and j > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (j, s)
    return {k: (round(j, 6), s) for k, (j, s) in out.items()}


def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    items = [(i, text_of(rng, rng.choice([20, 45, 60]))) for i in range(12)] + [(90, "one two"), (91, None), (92, "..."), (93, "ab " * 30)]
    docs = []
    for i in range(60):
        passage = items[rng.randrange(12)][1]
        passage = edited(rng, passage, rng.choice([0, 0, 1, 2, 9]))
        docs.append((i, f"{text_of(rng, 30)}. {passage.upper() if i % 3 else passage}! {text_of(rng, 25)}"))
    docs += [(100, None), (101, ""), (102, "x One, two y"), (103, "ab " * 500), (None, items[2][1]), (5, docs[5][1])]
    frame = docs_of(spark, docs).withColumnRenamed("key", "item_id")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_leaks(docs, items, 0.8) and len(got) > 20
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(frame, none).count() == 0 and leaks(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_leaks_at_the_threshold_with_distant_fingerprints(spark):
    pairs = []
    # Seeds whose item and passage, at a similarity of 0.8, have fingerprints 17 to 20 bits apart.
    for seed in (16, 440, 576, 40, 662, 952, 18, 859, 1338, 1845, 2766):
        rng = random.Random(seed)
        w = [f"w{rng.randrange(400)}" for _ in range(54)]
        pairs.append((seed, " ".join(w[:49]), f"{' '.join(w[:44] + w[49:])} and its end"))
    docs, items = [(i, d) for i, _, d in pairs], [(i, x) for i, x, _ in pairs]
    got = leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in got} == {(i, i): (0.8, 0) for i, _ in docs} == brute_leaks(docs, items, 0.8)


def test_decontamination_stage_drops_texts_shorter_than_the_item(spark, tmp_path):
    w = text_of(random.Random(6), 49).split()  # 45 shingles
    texts = [" ".join(w), " ".join(w[:48]), " ".join(w[2:46]), " ".join(w[:40]), " ".join(w[:39]), " ".join(w[:37] + ["other"]), w[0], None]
    spark.createDataFrame([(1, " ".join(w))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = leaks(docs, spark.read.parquet(str(tmp_path / "benchmark.parquet")), 0.8, short=True)
    assert {r.doc_id: (r.similarity, r.first_word) for r in found.collect()} == {
        0: (1.0, 0), 1: (round(44 / 45, 6), 0), 2: (round(40 / 45, 6), 0), 3: (0.8, 0)}
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {4, 5, 6, 7}


def test_fingerprints_are_majorities_of_bits(spark):
    rng = random.Random(3)
    sets = [[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 31, 300)]
    got = spark.createDataFrame([(s,) for s in sets], "h array<long>").select(fingerprint(F.col("h")).alias("f")).collect()
    for r, s in zip(got, sets):
        bits = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in s) > len(s))
        assert r.f & (2 ** 64 - 1) == bits
