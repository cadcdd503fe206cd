from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from framelake.llm import toxicity as X

INSULTS = ["idiot", "worthless", "trash", "loweiun"]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def prose(draw, words):
    syllables = ["th", "er", "on", "an", "re", "the", "ing", "lo", "id", "tra", "wor"]
    return [("".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))) for _ in range(words)]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(1)
    out = []
    for i in range(1200):
        words = prose(draw, draw.choice([20, 100, 600]))
        toxic = draw.random() < 0.25
        for _ in range(draw.randint(1, 3) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(INSULTS))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_accuracy_and_edges(spark, documents, rows):
    extra = [(5000, None), (5001, ""), (None, "an idiot"), (5002, "long text " * 200_000), (rows[0][0], rows[0][1])]
    docs = documents([(i, t, "en", "s") for i, t, _ in rows] + [(*e, None, None) for e in extra], clashes=True)
    labels = [(i, y, "x") for i, _, y in rows] + [(1, None, "x"), (None, 1, "x"), (rows[2][0], 0, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = X.score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == fold(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(by_id[i]["predicted"], y) for i, _, y in rows if fold(i)]
    assert np.mean([p == y for p, y in held]) > 0.95 and len(held) > 200
    assert by_id[None]["predicted"] == 1 and by_id[5000]["predicted"] == by_id[5001]["predicted"] == 0
    # The held-out labels play no part.
    flipped = spark.createDataFrame([(i, 1 - y if fold(i) else y, "x") for i, _, y in rows] + [(1, None, "x"), (None, 1, "x"), (rows[2][0], 0, "x")], "doc_id long, toxic int, text string")
    again = {r["doc_id"]: r["score"] for r in X.score_toxicity(docs, flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in got)


def test_log_count_ratios(spark, rows):
    some = [(t, y) for _, t, y in rows[:200]]
    counts = X.document_counts(spark.createDataFrame(some, "text string, toxic int").repartition(3))
    got = {r["bucket"]: (r["toxic"], r["clean"]) for r in counts.collect()}
    want: dict = {}
    for text, y in some:
        for b in {int(b) for part in X.ngram_buckets(text) for b in part}:
            t, c = want.get(b, (0, 0))
            want[b] = (t + y, c + 1 - y)
    assert got == want
    toxic, clean = sum(y for _, y in some), sum(1 - y for _, y in some)
    buckets, ratios = X.log_count_ratios(counts, toxic, clean)
    assert list(buckets) == sorted(buckets) and len(buckets)
    for b, r in zip(buckets.tolist(), ratios.tolist(), strict=True):
        t, c = want[b]
        assert abs(r - np.log(((t + 1) / (toxic + 2)) / ((c + 1) / (clean + 2)))) < 1e-9


def test_chunks_see_every_ngram(monkeypatch):
    text = "".join(prose(random.Random(2), 300))
    whole = X.Presence().of(text)
    monkeypatch.setattr(X, "_CHUNK", 37)
    assert np.array_equal(whole, X.Presence().of(text))


def test_one_class_and_empty_tables(spark, documents):
    docs = documents([(i, "some text") for i in range(8)])
    labels = spark.createDataFrame([(i, 0) for i in range(8)], "doc_id long, toxic int")
    scores = {round(r["score"], 6) for r in X.score_toxicity(docs, labels).collect()}
    assert len(scores) == 1 and scores.pop() < 0.3
    assert {r["score"] for r in X.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert X.score_toxicity(documents([]), labels).collect() == []


@pytest.mark.parametrize("entries", [5, 1 << 17])
def test_runs_and_fit_against_plain_sums(monkeypatch, entries):
    """Runs of any length, empty ones too, in blocks of any size; the fit
    stands where the gradient of the whole loss is nearly nothing."""
    monkeypatch.setattr(X, "_ENTRIES", entries)
    draw = np.random.Generator(np.random.PCG64(3))
    lengths = draw.integers(0, 12, 300)
    columns = np.concatenate([np.sort(draw.choice(30, n, replace=False)) for n in lengths]).astype(np.int32)
    values, rows = draw.normal(size=33), np.repeat(np.arange(300), lengths)
    assert np.allclose(X._Runs(columns, lengths).sums(values), np.bincount(rows, values[columns], minlength=300))
    labels, ratios = (draw.random(300) < 0.3).astype(int), draw.random(33) + 0.5
    monkeypatch.setattr(X, "ROUNDS", 3000)
    weights, bias = X.fit(labels, lengths, columns, ratios)
    error = 1 / (1 + np.exp(-np.bincount(rows, weights[columns], minlength=300) - bias)) - labels
    gradient = np.bincount(columns, error[rows], minlength=33) * ratios / 300 + X.RIDGE * weights / ratios
    assert abs(error.mean()) < 1e-3 and np.abs(gradient).max() < 1e-3
    assert X.fit(labels, np.zeros(300, dtype=int), columns[:0], ratios[:0])[0].size == 0


def test_no_feature_is_cut(spark):
    """However many buckets are clear, all are features."""
    counts = spark.range(40_000).selectExpr("id AS bucket", "id % 2 * 50 AS toxic", "0L AS clean")
    assert X.log_count_ratios(counts, 60, 60)[0].tolist() == list(range(1, 40_000, 2))


def test_repeated_sampled_id(spark, documents):
    """Rows of one sampled id count once, whatever their number and texts."""
    docs = documents([(0, t) for t in ["b", None, "c", "a"] * 50] + [(1, None), (1, None), (3, "d")])
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (3, 0)], "doc_id long, toxic int")
    got = [tuple(r) for r in X.training_rows(docs, labels, 10).collect()]
    assert sorted(got, key=repr) == sorted([(t, y) for i, t, y in [(0, "c", 1), (1, None, 1), (3, "d", 0)] if not fold(i)], key=repr)
