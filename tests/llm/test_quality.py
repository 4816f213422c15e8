"""Quality score: features and steps against plain loops, held-out accuracy, defined results of odd rows."""

import math
import zlib

import numpy as np
import pytest

from tabscore.llm import quality_ftrl as q
from tests.conftest import SF01

ODD = ["", "one", "a b", "Ha Ha Ha ha!!", "Xéß \n\t tail%%% | 12 ab12", "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " x́ 日本語 日本語", "w " * 500]


def plain_buckets(text):
    """Every feature of a text, one at a time."""
    def bucket(x):
        x &= 2 ** 64 - 1
        x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)
        return (x >> 46) % q.BUCKETS
    words = [q.symbols(t) for t in text.split()]
    shapes = [2 * s + int(i > 0 and words[i - 1][0] == f) for i, (f, s) in enumerate(words)]
    prime, out = 0x100000001B3, []
    for i, (f, _) in enumerate(words):
        out += [bucket(f + (1 << 58)), bucket(shapes[i] + (2 << 58))]
        if i:
            out += [bucket((words[i - 1][0] * prime + f) % 2 ** 64 + (3 << 58)), bucket((shapes[i - 1] * prime + shapes[i]) % 2 ** 64 + (4 << 58))]
        if i > 1:
            out.append(bucket((shapes[i - 2] * prime * prime + shapes[i - 1] * prime + shapes[i]) % 2 ** 64 + (5 << 58)))
    return sorted(out)


def test_features_equal_plain_loops():
    owner, at = q.buckets(ODD, q.Words(most=3))
    for k, text in enumerate(ODD):
        assert sorted(at[owner == k].tolist()) == plain_buckets(text), text


def test_steps_equal_plain_ftrl():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        at = sorted(rng.choice(30, 5, replace=False).tolist())
        rows.append((at, rng.random(5).round(3).tolist(), int(rng.random() < 0.5 + 0.4 * (3 in at)), 1.5))
    model = q.fit(rows, rounds=2, rate=0.3, smooth=1.0, l1=0.01, l2=0.1)
    z, n = [0.0] * 31, [0.0] * 31

    def weight(i):
        if abs(z[i]) <= 0.01:
            return 0.0
        return -(z[i] - math.copysign(0.01, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.3 + 0.1)
    for _ in range(2):
        for at, x, y, k in rows:
            at, x = [*at, 30], [*x, 1.0]
            w = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, xi, wi in zip(at, x, w):
                g = (p - y) * k * xi
                s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3
                z[i] += g - s * wi
                n[i] += g * g
    assert model.weights[:30] == pytest.approx([weight(i) for i in range(30)], abs=1e-6)
    assert model.bias == pytest.approx(weight(30), abs=1e-9)


def test_scores_are_dot_products():
    rng = np.random.default_rng(5)
    model = q.Model(rng.normal(size=q.BUCKETS).astype(np.float32), 0.25)
    for text, found in zip(ODD, model.scores(ODD)):
        at = plain_buckets(text)
        logit = 0.25 + q.MASS * (sum(float(model.weights[i]) for i in at) / len(at) if at else 0)
        assert found == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, logit)))), abs=1e-6)


def test_held_out_rows_of_the_given_table(spark):
    out = q.op11_quality_ftrl(spark, SF01)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()]
    held = [(rows[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.95
    good, bad = [r.score for r, y in held if y], [r.score for r, y in held if not y]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) as binary)) % 4 = 2, 1 - quality, quality) quality", "toxic")
    a, b = q.learn(docs, labels), q.learn(docs, turned.repartition(5))
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_odd_rows(spark):
    shape = "doc_id long, text string, lang string, score string, held_out int, _text int, at int"
    rows = [(1, "Fine words here.", "en", "x", 1, 1, 1), (1, "Fine words here.", "en", "x", 1, 1, 1), (None, "JUNK!! JUNK!!", None, None, None, None, None),
            (3, None, "en", "x", 1, 1, 1), (4, "", "en", "x", 1, 1, 1), (6, "JUNK!! JUNK!! JUNK!!", "en", "x", 1, 1, 1), (8, "word " * 200_000, "en", "x", 1, 1, 1)]
    docs = spark.createDataFrame(rows, shape)
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (3, None), (99, 0), (None, 1)], "doc_id long, quality int")
    model = q.learn(docs, labels)
    got = sorted(map(tuple, q.score(docs, model).collect()), key=str)
    assert len(got) == len(rows)
    by = {}
    for i, held, s, p in got:
        by.setdefault(i, []).append((held, s, p))
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and by[None][0][0] is False
    assert by[3][0][1:] == by[4][0][1:] and by[1][0][1] > by[6][0][1]
    one = q.learn(docs, labels.where("quality = 1"))
    assert {round(r.score, 3) for r in q.score(docs, one).collect()} == {1.0}
    none = q.learn(docs.limit(0), labels.limit(0))
    assert {r.score for r in q.score(docs, none).collect()} == {0.5}
    assert q.score(docs.limit(0), model).count() == 0
