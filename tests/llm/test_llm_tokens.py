"""Rank-array merges, token alignment and whitening against the libraries, plain Python and numpy."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wickline.llm import alignment, pieces, queries, rank_bpe, whitening

FOLDER = queries.TOKENIZERS
WORDS, BYTES, PIECES = f"{FOLDER}/word_bpe_49k.json", f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
POOL = "aAbBéÉΣσİ  '''sstTre0123日本̸́\t\n \x1c\x85\U0001f600Րß<|>\U000e0101"


def odd_texts(seed, n, extra=""):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(POOL + extra) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*texts, None, "", " ", "  ", "a", " a  b ", "x" * 3000, "ab " * 4000, " " * 500, "<|endoftext|> x<|startoftext|>", "<s> </s>", "a\0b"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts(2, 400))]
    return spark.createDataFrame([*rows, rows[0], (None, "no id", None)], "doc_id long, text string, ids string")


def test_merges_equal_the_library():
    with open(WORDS, encoding="utf-8") as f:
        bpe = rank_bpe.RankBpe(f.read())
    library, rng = Tokenizer.from_file(WORDS), random.Random(3)
    texts = [t for t in odd_texts(4, 3000) if t]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(5000)), "ab" * 2000 + "c" * 500, "." * 3000]
    # Letters that only a newer Unicode knows are cut as the library does.
    texts.append(" ".join(f"a{chr(c)}b{chr(c)}" for c in [*range(0x1C80, 0x1CA0), *range(0x10940, 0x10960), *range(0xA7C0, 0xA7F8)]))
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == want, repr(text[:80])
        assert bpe.decode(want) == library.decode(want, skip_special_tokens=False)
    assert bpe.decode([10 ** 6]) == ""


def test_scan_and_heap_merge_alike(monkeypatch):
    with open(WORDS, encoding="utf-8") as f:
        bpe = rank_bpe.RankBpe(f.read())
    rng = random.Random(9)
    words = ["".join(rng.choice("aeinrstlo") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    scanned = [bpe.word(w) for w in words]
    monkeypatch.setattr(rank_bpe, "LONG", 1)
    assert [bpe.word(w) for w in words] == scanned


def test_other_tokenizer_files_are_refused():
    with open(BYTES, encoding="utf-8") as f, pytest.raises((ValueError, TypeError)):
        rank_bpe.RankBpe(f.read())


def test_rank_bpe_query_and_odd_rows(spark, odd, tmp_path):
    shared = rank_bpe.share_vocabulary(spark, WORDS)
    library = Tokenizer.from_file(WORDS)
    rows = rank_bpe.decode(rank_bpe.encode(odd.withColumn("decoded", F.lit(1)), shared), shared).collect()
    assert len(rows) == odd.count() and rank_bpe.encode(odd.limit(0), shared).count() == 0
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == library.decode(want, skip_special_tokens=False)
    odd.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = collections.Counter(tuple(r) for r in queries.op13_rank_bpe(spark, str(tmp_path)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids
    assert got == collections.Counter(
        (r.doc_id, len(i), sha(np.array(i, dtype="<u4").tobytes()), sha(library.decode(i, skip_special_tokens=False).encode()))
        for r in odd.collect() for i in [ids(r.text)])


def spans_by_bytes(a, b, text):
    """Groups and links of a whole text from the decoded bytes of its tokens alone."""
    letters = {c: i for i, c in enumerate(rank_bpe.byte_letters())}
    whole = a.encode(" " + text, add_special_tokens=False)
    left = [bytes(letters[c] for c in t) for t in whole.tokens]
    ids = b.encode(text)
    right = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids for p in [b.id_to_piece(i)]]
    raw = (" " + text).encode()
    if not text or b"".join(left) != raw or b"".join(right) != raw:
        return None
    at_a, at_b = np.cumsum([0, *map(len, left)]), np.cumsum([0, *map(len, right)])
    links = [(whole.ids[i], ids[j]) for i in range(len(left)) for j in range(
        max(np.searchsorted(at_b, at_a[i], side="right") - 1, 0), np.searchsorted(at_b, at_a[i + 1]))]
    cuts = [0, *sorted(set(at_a[1:].tolist()) & set(at_b[1:].tolist()))]
    groups = ";".join(
        ",".join(str(x) for x, e in zip(whole.ids, at_a[1:]) if lo < e <= hi) + "|" + ",".join(str(x) for x, e in zip(ids, at_b[1:]) if lo < e <= hi)
        for lo, hi in zip(cuts, cuts[1:]))
    return len(left), len(right), len(cuts) - 1, links, groups


def brute_alignment(rows):
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    found = [(i, spans_by_bytes(a, b, t or "")) for i, t in rows]
    count = collections.Counter(x for _, f in found if f for x in f[3])
    most = collections.defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return collections.Counter(
        (i, *f[:3], len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(f[4].encode()).hexdigest())
        if f else (i, 0, 0, 0, 0, 0, 0, "") for i, f in found)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_decoded_bytes(spark, tmp_path, sf):
    rows = [(i, t) for i, t in enumerate(odd_texts(6, 300, "▁ ") + ["the the cat", "the cat the", "日本語 テスト"])]
    rows += [rows[7], (None, "no id"), *((1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    want = brute_alignment(rows)
    got = queries.op12_alignment(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert collections.Counter(tuple(r) for r in got) == want and sum(r.n_a == 0 for r in got) > 10
    # More pairs than are broadcast: the same by a join.
    shared = alignment.share_tokenizers(spark, BYTES, PIECES)
    aligned = alignment.align(frame.withColumn("n_best", F.lit("clash")).withColumn("groups", F.lit(2)), shared)
    joined = alignment.score_links(aligned, shared, most_pairs=3)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    assert collections.Counter(tuple(r) for r in joined.select(*COLUMNS[:-1], digest).collect()) == want


def test_alignment_of_parts_and_of_an_empty_table(spark, monkeypatch):
    with open(BYTES, encoding="utf-8") as f, open(PIECES, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    texts = [t for t in odd_texts(8, 2000, "▁") if t]
    by_part, aligner.cut = [aligner.describe(t) for t in texts], None
    assert [aligner.describe(t) for t in texts] == by_part
    shared = alignment.share_tokenizers(spark, BYTES, PIECES)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score_links(alignment.align(none, shared), shared).count() == 0
    empty = spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")
    assert [tuple(r) for r in alignment.score_links(alignment.align(empty, shared), shared, 0).collect()] == [(1, 0, 0, 0, 0, "", 0, 0)] * 2


def exact_whitening(vectors, count):
    x = np.array(sorted(set(map(tuple, vectors))), dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, q = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1][:count], q[:, ::-1][:, :count], values.sum()


def test_whitening_equals_the_exact_eigenvectors(spark):
    rng = np.random.default_rng(1)
    near = rng.standard_normal((400, 40)) * np.linspace(1.0, 1.3, 40)  # eigenvalues that lie close together
    rows = [(i, v.tolist(), "x") for i, v in enumerate(near)] + [(1000 + i, near[3].tolist(), "copy") for i in range(300)]
    rows += [(5000, None, ""), (5001, [float("nan")] * 40, ""), (5002, [None] * 40, ""), (5003, [float("inf")] * 40, ""), (5004, [], ""),
             (5005, [1.0, 2.0], ""), (5006, [1e300] * 40, ""), rows[0]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string")
    vectors = whitening.grid_vectors(frame)
    assert {r.vec_id for r in vectors.collect()} == {r[0] for r in rows} - {5000, 5001, 5002, 5003, 5006}
    model = whitening.fit_whitening(vectors, 16, guard=6)
    x = {i: [int(np.floor(64 * c)) + 1_000_000 for c in v] for i, v, _ in rows if i < 5000}
    n, sums, values, q, trace = exact_whitening(x.values(), 16)
    assert model.n == n == 400 and (model.sums == sums).all() and model.passes > 20
    np.testing.assert_allclose(model.values, values, rtol=1e-12)
    np.testing.assert_allclose(model.explained, values / trace, rtol=1e-9)
    assert model.identity_error < 1e-10 and model.residual < 1e-12 * values[0]
    signs = np.sign((model.vectors * q).sum(axis=0))
    np.testing.assert_allclose(model.vectors * signs, q, atol=1e-10)
    got = whitening.by_component(whitening.whiten(vectors, model), model).collect()
    assert len(got) == 16 * 701 and {r.component for r in got} == set(range(1, 17))
    for r in got[::97]:
        num = np.array(x[r.vec_id]) * n - sums
        assert r.deviation == int((num * num).sum()) and r.n == n
        assert abs(r.whitened * signs[r.component - 1] - num / n @ q[:, r.component - 1] / np.sqrt(values[r.component - 1])) < 1e-9


def test_whitening_of_few_and_equal_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, x array<long>")
    none = frame([])
    assert whitening.fit_whitening(none) is None and whitening.by_component(whitening.whiten(none, None), None).count() == 0
    same = frame([(1, [5, 6]), (2, [5, 6])])
    model = whitening.fit_whitening(same)
    got = whitening.by_component(whitening.whiten(same, model), model).collect()
    assert model.n == 1 and {(r.whitened, r.deviation, r.identity_error) for r in got} == {(None, 0, 0.0)} and len(got) == 4
    line = frame([(i, [i, 2 * i, 7]) for i in range(9)])  # one direction varies
    model = whitening.fit_whitening(line)
    got = {(r.vec_id, r.component): r.whitened for r in whitening.by_component(whitening.whiten(line, model), model).collect()}
    assert abs(abs(got[0, 1]) - 4 / np.sqrt(60 / 9)) < 1e-12 and got[0, 2] is None and abs(model.explained[0] - 1) < 1e-12
    wide = frame([(0, [-(1 << 30)]), (1, [1 << 30])])
    assert {r.deviation for r in whitening.whiten(wide, whitening.fit_whitening(wide)).collect()} == {1 << 62}


def test_whole_numbers_of_any_size():
    x = np.array([[1 << 60, 5]])
    assert whitening.numerators(x, 1 << 10, np.array([3, 4])).tolist() == [[(1 << 70) - 3, 5 * 1024 - 4]]


def test_recode_equals_encode_then_decode_and_leaves_no_units_behind(spark):
    docs = spark.createDataFrame([(1, "a tree ü\n x"), (2, None), (3, ""), (3, "a tree ü\n x")], "doc_id long, text string")
    model = pieces.share_model(spark, f"{queries.TOKENIZERS}/piece_bpe_32k.model")
    both = [pieces.recode(docs, model), pieces.decode(pieces.encode(docs, model), model)]
    assert both[0].columns == both[1].columns and sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    batch = pa.RecordBatch.from_arrays([pa.array(["some words here"])], names=["text"])
    assert sum(b.num_rows for b in pieces._recode(iter([batch]), model, ["text"])) == 1
    assert not pieces._transducer(model).known
