"""Hard negatives, the filter audit and the quality model against plain versions."""

import zlib

import numpy as np
import pytest

from learner_scoring.llm import filter_audit, hard_negatives, quality_model
from learner_scoring.llm import queries as Q
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.test_operators import TEXTS, same, words

VECTOR = "vec_id long, embedding array<float>, label int, q string, score int"


def vectors(spark, data):
    return spark.createDataFrame([(*r, "x", 1) for r in data], VECTOR)


def clustered(seed, n, dims=8, labels=4, spread=0.5):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(labels, dims))
    return [(i, (centers[i % labels] + spread * r.normal(size=dims)).tolist(), int(r.integers(0, labels))) for i in range(n)]


def mined(df, **kw):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return [tuple(r[c] for c in cols) for r in hard_negatives.mine(df, **kw).collect()]


ODD = [
    (None, [1.0] * 8, 1), (600, None, 1), (650, [1.0, None] + [0.0] * 6, 1), (700, [float("nan")] * 8, 1), (750, [float("inf")] * 8, 1),
    (800, [0.5] * 8, None), (850, [], 2), (900, [0.25, 0.5], 2), (950, [0.0] * 8, 3), (100, [0.9] * 8, 0), (100, [0.9] * 8, 0), (1050, [1.0] * 8, 77),
]


def test_hard_negatives(spark, monkeypatch):
    data = clustered(1, 400) + [(400 + i, [0.5 + 0.01 * (i % 3)] * 8, i % 3) for i in range(60)] + ODD
    d = vectors(spark, data)
    want = brute.hard_negatives([r.asDict() for r in d.collect()])
    assert len(want) > 100 and len({w[0] for w in want}) > 8
    same(mined(d), want)
    monkeypatch.setattr(hard_negatives, "BLOCK", 37)
    monkeypatch.setattr(hard_negatives, "GROUP", 4)
    monkeypatch.setattr(hard_negatives, "DIMS", 3)
    monkeypatch.setattr(hard_negatives, "BROADCAST_BYTES", 0)
    same(mined(d), want)
    assert mined(d.limit(0)) == [] and mined(d.filter("vec_id = 1")) == [] and mined(d.filter("vec_id = 50")) == []


def test_hard_negatives_repeated_rows(spark):
    """A third of all rows one vector; an anchor twice."""
    data = clustered(2, 60) + [(150, [0.7] * 8, 1)] * 2 + [(151, [0.7] * 8, 2)] * 31
    want = brute.hard_negatives([dict(zip(("vec_id", "embedding", "label"), r)) for r in vectors(spark, data).select("vec_id", "embedding", "label").collect()])
    same(mined(vectors(spark, data)), want)


def test_hard_negatives_large_components(spark):
    data = [(50 * i, [10.0 ** (i + k) for k in range(4)], i % 2) for i in range(6)] + [(1 + 2 * i, [1e3 * i, -1.0, 2.0, 1e5], i % 2) for i in range(20)]
    d = vectors(spark, data)
    same(mined(d), brute.hard_negatives([r.asDict() for r in d.collect()]))


@pytest.mark.parametrize("seed", range(6))
def test_threshold_scores_lose_nothing(seed):
    r = np.random.default_rng(seed)
    x, a = (r.normal(size=(n, 20)) * 256 * r.random((n, 1)) ** 2 for n in (300, 9))
    x, a = np.floor(x).astype(np.int64), np.floor(a).astype(np.int64)
    full = a @ x.T
    for share in (0.9, 0.5, 0.2, 0.0):
        low = share * full.max(1) * r.random(9)
        rows, score = hard_negatives.threshold_scores(a, x, low)
        assert (score == full[:, rows]).all()
        assert not (np.delete(full, rows, axis=1) >= low[:, None]).any()
    assert len(hard_negatives.threshold_scores(a, x, np.full(9, full.max()))[0]) < 300


LABELS = [(0, 1, 0), (3, 1, 1), (4, 1, 1), (4, 0, 0), (10, None, 1), (11, 0, None), (None, 1, 1), (99, 1, 1), (31, 1, 1)]


def audited(docs, labels):
    cols = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return [tuple(r[c] for c in cols) for r in filter_audit.audit(docs, labels).collect()]


def test_filter_audit(spark, monkeypatch):
    long = words(150, 5, 9000)
    texts = TEXTS + [long, long.upper(), long + " #", long, long, words(120, 6, 30)] + ["copied text"] * 25 + [words(20_000, 7, 90_000)]
    data = [(i if i != 6 else None, t, ["en", "de", "", None][i % 4], i, "part") for i, t in enumerate(texts)]
    data += [data[21], (20, "other text", "en", 1, "p"), (None, "copied text", "fr", 1, "p"), (None, "copied text", "fr", 1, "p")]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, n long, part string")
    labels = spark.createDataFrame([(*x, "t") for x in LABELS], "doc_id long, quality int, toxic int, text string")
    want = brute.audit([r.asDict() for r in d.collect()], [r.asDict() for r in labels.collect()])
    assert len(want) == 4 * 600 and any(w[7] for w in want) and any(w[8] for w in want)
    same(audited(d, labels), want)
    monkeypatch.setattr(filter_audit, "GROUP_ROWS", 3)  # the copied text is dealt over salts
    monkeypatch.setattr(filter_audit, "MAX_SALTED", 100)
    same(audited(d, labels), want)
    assert audited(d.limit(0), labels) == []
    none = audited(d, labels.limit(0))
    assert sorted(n[:7] for n in none) == sorted(w[:7] for w in want) and not any(n[7] or n[8] for n in none)


def test_context_sums_do_not_depend_on_pieces(monkeypatch):
    """Context sums of a text cut into small pieces equal a count of neighbours, word by word."""
    text = (words(500, 8, 60) + ", end.\n").encode()
    ids = np.concatenate(list(quality_model.token_ids(text)))
    monkeypatch.setattr(quality_model, "PIECE", 64)
    assert (np.concatenate(list(quality_model.token_ids(text))) == ids).all()
    index = quality_model.index_vectors()
    sums = np.zeros((quality_model.BUCKETS + 1, quality_model.DIM), np.int64)
    monkeypatch.setattr(quality_model, "SLICE", 17)
    quality_model._context(ids, index, sums)
    want = np.zeros_like(sums)
    for i, own in enumerate(ids):
        for j in range(max(0, i - 2), min(len(ids), i + 3)):
            if j != i:
                want[own] += index[ids[j]].astype(np.int64)
    assert (sums == want).all()


def test_word_vectors_do_not_depend_on_partitions(spark, monkeypatch):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    one = quality_model.word_vectors(d.coalesce(1))
    assert (quality_model.word_vectors(d.repartition(7)) == one).all()
    assert one.shape == (quality_model.BUCKETS, quality_model.DIM)


def test_quality_model_on_held_out_rows(spark):
    """Held-out labels: right at the threshold in 95 of 100, and calibrated in the large."""
    got = {r["doc_id"]: r for r in Q.op13_quality_classifier(spark, SF01).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    held = [i for i in labels if got[i]["held_out"]]
    assert len(held) > 50
    assert np.mean([got[i]["predicted"] == labels[i] for i in held]) >= 0.95
    assert abs(np.mean([got[i]["score"] for i in held]) - np.mean([labels[i] for i in held])) < 0.08


def test_quality_model_learns_nothing_from_held_out_labels(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) quality", "toxic")
    read = lambda x: sorted(map(tuple, quality_model.score(d, x).collect()))
    assert read(labels) == read(turned)


def test_quality_model_edges(spark):
    data = [(i, t, "s", 0.5, True) for i, t in enumerate(TEXTS)] + [(None, "no id", "s", 0.5, True), (3, "twice", "s", 0.5, True), (50, words(300_000, 9), "s", 0.5, True)]
    d = spark.createDataFrame(data, "doc_id long, text string, features string, score double, held_out boolean")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, score string")
    some = quality_model.score(d, labels([(i, i % 2, "x") for i in range(20)] + [(None, 1, "x"), (5, None, "x"), (3, 1, "x")]), sample=9).collect()
    assert len(some) == len(data) and all(0 <= r["score"] <= 1 for r in some)
    assert {r["held_out"] for r in some if r["doc_id"] is None} == {False}
    assert {r["score"] for r in quality_model.score(d, labels([])).collect()} == {0.5}
    ones = {r["score"] for r in quality_model.score(d, labels([(i, 1, "x") for i in range(20)])).collect()}
    assert len(ones) == 1 and 0.9 < ones.pop() < 1
    assert quality_model.score(d.limit(0), labels([(1, 1, "x")])).count() == 0
