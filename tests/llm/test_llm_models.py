"""Language, severity and pieces: held-out accuracy, order of grades, brute-force paths and round trips."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wickline.llm import language, pieces, severity

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LETTERS = {"aa": "abcdef", "bb": "uvwxyz", "cc": "defuvw"}


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, LETTERS[lang], rng.randint(3, 60)), lang) for i in range(900) for lang in [rng.choice(list(LETTERS))]]
    return spark.createDataFrame([*rows, (9000, "abc", None), (9001, None, "aa"), (9002, "", "bb")], "doc_id long, text string, lang string")


def test_language_of_held_out_rows(spark, spoken):
    held = F.col("doc_id") % 3 == 1
    model = language.fit(spoken.where(~held), F.col("doc_id"))
    got = language.identify(spoken.where(held).withColumn("n", F.lit(1)), model).where("lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert model.languages == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.5 and model.temperature > 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 .. 4\n"), (4, "ab" * 3_000_000)], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in language.identify(odd, model).orderBy("doc_id").take(3)] == [("und", 0.0)] * 3
    assert language.identify(odd.limit(0), model).count() == 0


def test_language_without_rows_is_unknown(spark, spoken):
    model = language.fit(spoken.limit(0), F.col("doc_id"))
    assert {r.lang_pred for r in language.identify(spoken, model).collect()} == {"und"}


def test_grams_of_long_texts_are_those_of_their_pieces(monkeypatch):
    text = words(random.Random(1), "abcü ", 500)
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 37)
    assert all((a == b).all() for a, b in zip(whole, language.gram_counts(text)))


@pytest.fixture(scope="module")
def rated(spark):
    rng = random.Random(8)
    rows = []
    for i in range(800):
        text = words(rng, "abcdefgh", rng.randint(5, 200)).split()
        bad = i % 5 == 0
        for _ in range(rng.randint(1, 12) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(["zzmean", "qqvile", f"kkrude{rng.choice('xyz')}{rng.choice('pqr')}"])
        rows.append((i, " ".join(text), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, grade int"), [(i, y) for i, _, y in rows]


def test_severity_orders_and_separates(spark, rated):
    docs, truth = rated
    labels = spark.createDataFrame([*truth[:600], (None, 1), (3, None)], "doc_id long, toxic int")
    model = severity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in severity.grade(docs, model).collect()}
    assert np.mean([got[i].toxic == bool(y) for i, y in truth[600:]]) > 0.98
    assert not any(got[i].toxic for i, y in truth if not y)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "zzmean"), (4, "ZZMEAN! qqvile, kkrudenew zzmean"), (5, "a " * 400_000)], "doc_id long, text string")
    said = [r.expected_severity for r in severity.grade(odd, model).orderBy("doc_id").collect()]
    assert said[0] == said[1] == said[4] < said[2] < said[3] <= 3
    assert severity.grade(odd.limit(0), model).count() == 0


def test_severity_without_labels_is_clean(spark, rated):
    docs, _ = rated
    model = severity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert severity.grade(docs, model).where("toxic").count() == 0


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (600, 3))
    grade = np.clip((x @ [2, 1, 0]), 0, 3).astype(int)
    row, column = np.nonzero(x)
    w, cuts = severity.fit_ordinal(row, column, np.ones(len(row)), grade, 3, 4)
    assert w[0] > w[1] > abs(w[2]) and (np.diff(cuts) > 0).all()


def small():
    made = [("", 0.0), ("a", -5.0), ("b", -5.5), ("ab", -6.0), ("▁", -3.0), ("▁a", -4.0), ("abb", -6.5), ("bb", -2.0), ("▁▁", -1.0)]
    return pieces.Transducer([*made, *[("", 0.0)] * 256], list(range(len(made), len(made) + 256))), made


def best_path(transducer, made, unit):
    """(cost, pieces, reversed lengths) over all cuts of a short unit."""
    arcs = {t: round(-s * pieces.UNIT_COST) for t, s in made if t}
    found = {0: (0, 0)}
    for j in range(1, len(unit) + 1):
        options = [(found[i][0] + arcs[unit[i:j]], found[i][1] + 1) for i in range(j) if unit[i:j] in arcs]
        raw = len(unit[j - 1].encode())
        options.append((found[j - 1][0] + pieces.BYTE_COST * raw, found[j - 1][1] + raw))
        found[j] = min(options)
    return found[len(unit)]


def test_shortest_paths_equal_brute_force():
    transducer, made = small()
    rng = random.Random(6)
    costs = {i: round(-s * pieces.UNIT_COST) for i, (t, s) in enumerate(made) if t}
    for _ in range(500):
        unit = "▁" * rng.randint(0, 3) + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 9)))
        path = transducer.shortest_path(unit)
        assert (sum(costs.get(i, pieces.BYTE_COST) for i in path), len(path)) == best_path(transducer, made, unit)
        assert b"".join(transducer.bytes_of[i] for i in path).decode() == unit


def test_units_change_no_path():
    transducer = pieces.Transducer.load(open(MODEL, "rb").read())
    for text in ["Hello  world\nabc é😀", " a", "   ", "x\n\n\ty  z ", "naïve 你好 \x00 end"]:
        whole = transducer.shortest_path(transducer.normalise(text))
        assert transducer.encode(text).tolist() == whole and transducer.decode(transducer.encode(text)) == text
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sp.decode(transducer.encode("The quick brown fox.").tolist()) == "The quick brown fox."


def test_encode_and_decode_tables(spark):
    shared = pieces.share_model(spark, MODEL)
    texts = [None, "", "plain words", "two  blanks ", "ü\n" * 50, "a" * 100_000, "plain words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    rows = pieces.decode(pieces.encode(docs, shared), shared).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == [t or "" for t in texts] and rows[0]["ids"] == [] and rows[2]["ids"] == rows[6]["ids"]
    assert pieces.encode(docs.limit(0), shared).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing, shared).first().decoded is None


def test_pieces_that_cross_words_are_refused():
    with pytest.raises(ValueError):
        pieces.Transducer([("a▁b", -1.0), *[("", 0.0)] * 256], list(range(1, 257)))
