"""Samples and splits (F1, J1-J4) against brute force on the md5 order."""

import hashlib
import math

import pytest

from tabscore.operators import sampling as smp
from tabscore.plans import ranks

from .conftest import SF001


def _md5(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def orders(spark):
    from tabscore.plans import fixtures as fx
    return fx.orders_t(spark, SF001).select("o_orderkey", "done").cache()


def _rows(orders):
    return [(r.o_orderkey, r.done) for r in orders.collect()]


def test_random_top_is_md5_top(orders):
    rows = _rows(orders)
    want = sorted(rows, key=lambda r: (_md5(42, r[0]), r[0]))[:37]
    got = smp.random_top(orders, 37, ["o_orderkey"]).collect()
    assert sorted(r.o_orderkey for r in got) == sorted(r[0] for r in want)


def test_balanced_sample(orders):
    rows = [r for r in _rows(orders) if r[1] is not None]
    n = 300
    pos = sorted([r for r in rows if r[1]], key=lambda r: _md5(42, r[0]))[:n // 3]
    neg = sorted([r for r in rows if not r[1]], key=lambda r: _md5(42, r[0]))[:n - n // 3]
    got = smp.balanced_sample(orders, "done", n, ["o_orderkey"]).collect()
    assert sorted(r.o_orderkey for r in got) == sorted(r[0] for r in pos + neg)


def test_rank_in_class_is_exact(orders):
    rows = [r for r in _rows(orders) if r[1] is not None]
    got = {r.o_orderkey: r["rank"] for r in
           ranks.rank_in_class(orders.where("done IS NOT NULL"), ["done"], ["o_orderkey"], buckets=8).collect()}
    for cls in (True, False):
        order = sorted([r for r in rows if r[1] == cls], key=lambda r: _md5(42, r[0]))
        assert [got[r[0]] for r in order] == list(range(1, len(order) + 1))


@pytest.mark.parametrize("buckets", [1, 7, 1 << 18])
def test_stratified_split_quota(orders, buckets, monkeypatch):
    monkeypatch.setattr(ranks, "DEFAULT_BUCKETS", buckets)
    rows = [r for r in _rows(orders) if r[1] is not None]
    split = {r.o_orderkey: r.split for r in smp.stratified_split(orders, "done", 0.2, ["o_orderkey"]).collect()}
    n_test = math.ceil(0.2 * len(rows))
    assert sum(1 for v in split.values() if v == "test") == n_test
    for cls in (True, False):
        order = sorted([r for r in rows if r[1] == cls], key=lambda r: _md5(42, r[0]))
        flags = [split[r[0]] for r in order]
        k = flags.count("test")
        assert flags == ["test"] * k + ["train"] * (len(flags) - k)
        assert abs(k - n_test * len(order) / len(rows)) <= 1


def test_folds_balanced(orders):
    f = smp.stratified_folds(orders, "done", 3, ["o_orderkey"]).groupBy("done", "fold").count().collect()
    by = {}
    for r in f:
        by.setdefault(r.done, []).append(r["count"])
    for counts in by.values():
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


def test_hash_fraction_matches_python(orders):
    rows = _rows(orders)
    want = {k for k, _ in rows if int(_md5(42, k)[:8], 16) / 2 ** 32 < 0.1}
    got = {r.o_orderkey for r in smp.hash_fraction(orders, 0.1, ["o_orderkey"]).collect()}
    assert got == want


def quota_of(totals, p):
    """Largest-remainder quotas in plain Python."""
    total = sum(totals.values())
    n_test = math.ceil(p * total)
    out = {c: n_test * n // total for c, n in totals.items()}
    for _, c in sorted((-(n_test * n % total), c) for c, n in totals.items())[:n_test - sum(out.values())]:
        out[c] += 1
    return out


@pytest.mark.parametrize("totals,p", [({"a": 7, "b": 3}, 0.25), ({"x": 4933, "y": 4979}, 0.2), ({"a": 1}, 0.5), ({"p": 5, "q": 5, "r": 5}, 0.2)])
def test_test_quota_largest_remainder(spark, totals, p):
    df = spark.createDataFrame([((c, 0), n) for c, n in totals.items()], "_k struct<c0:string,_:int>, n long")
    assert {r["_k"]["c0"]: r["_q"] for r in smp.test_quota(df, p).collect()} == quota_of(totals, p)


def test_split_quota_holds_on_repeated_keys(spark):
    rows = [(i % 7, "ab"[i % 3 == 0]) for i in range(210)]
    df = spark.createDataFrame(rows, "k long, c string").repartition(6)
    out = smp.stratified_split(df, "c", 0.2, ["k"])
    got = {(r["c"], r["split"]): r["count"] for r in out.groupBy("c", "split").count().collect()}
    want = quota_of({"a": 140, "b": 70}, 0.2)
    assert got == {("a", "test"): want["a"], ("a", "train"): 140 - want["a"], ("b", "test"): want["b"], ("b", "train"): 70 - want["b"]}
    loose = smp.stratified_split(spark.createDataFrame(rows, "k long, c string"), "c", 0.2, ["k"], exact=False)
    assert "Exchange" not in loose._jdf.queryExecution().executedPlan().toString()


def test_folds_from_fraction_without_shuffle(orders):
    f = smp.stratified_folds(orders, "done", 3, ["o_orderkey"], exact=False)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    counts = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(counts) == 3 and min(counts) > 0.25 * sum(counts)


@pytest.mark.parametrize("buckets", [3, 64])
def test_split_exact_with_skewed_classes(spark, buckets, monkeypatch):
    """Three classes of very different sizes (status P is about 2%)."""
    monkeypatch.setattr(ranks, "DEFAULT_BUCKETS", buckets)
    o = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_orderstatus")
    rows = [(r.o_orderkey, r.o_orderstatus) for r in o.collect()]
    split = {r.o_orderkey: r.split for r in smp.stratified_split(o, "o_orderstatus", 0.1, ["o_orderkey"]).collect()}
    totals = {}
    for _, c in rows:
        totals[c] = totals.get(c, 0) + 1
    for cls, q in quota_of(totals, 0.1).items():
        order = sorted([k for k, c in rows if c == cls], key=lambda k: _md5(42, k))
        assert [split[k] for k in order] == ["test"] * q + ["train"] * (len(order) - q)


def test_smallest_by_hash_per_class(orders):
    """Exact per-class md5 top-n."""
    rows = [r for r in _rows(orders) if r[1] is not None]
    quota = {(True,): 40, (False,): 25}
    got = ranks.smallest_by_hash(orders.where("done IS NOT NULL"), quota, ["o_orderkey"], 42,
                                 class_cols=["done"])
    want = set()
    for cls, n in quota.items():
        part = sorted((r for r in rows if r[1] == cls[0]), key=lambda r: (_md5(42, r[0]), r[0]))
        want |= {r[0] for r in part[:n]}
    assert {r.o_orderkey for r in got.collect()} == want


def test_leading_zeros_exact(spark):
    from pyspark.sql import functions as F
    vals = [0, 1, 2, 3, 0xFFFF, 0x10000, 0x7FFFFFFF, 0x80000000, 0xFFFFFFFF] + [(1 << k) - 1 for k in range(1, 33)] \
        + [1 << k for k in range(32)]
    df = spark.createDataFrame([(f"{v:08x}" + "0" * 24,) for v in vals], "h string")
    got = [r["z"] for r in df.select(ranks.leading_zeros32(F.col("h")).alias("z")).collect()]
    assert got == [32 - v.bit_length() for v in vals]


@pytest.mark.parametrize("n", [3, 40, 100000])
def test_smallest_per_class_brute_force(spark, n):
    from tabscore.plans import fixtures as fx
    o = fx.orders_t(spark, SF001).select("o_orderkey", "o_orderpriority", "done")
    rows = [(r.o_orderkey, r.done) for r in o.collect()]
    got = ranks.smallest_per_class(o, ["done"], n, ["o_orderkey"], 42)
    want = set()
    for cls in {r[1] for r in rows}:           # NULL is a class of its own
        part = sorted((r for r in rows if r[1] == cls), key=lambda r: (_md5(42, r[0]), r[0]))
        want |= {r[0] for r in part[:n]}
    got_keys = [r.o_orderkey for r in got.collect()]
    assert len(got_keys) == len(set(got_keys)) and set(got_keys) == want


@pytest.mark.parametrize("cut", [0.5, 2.0])
def test_fallback_sample_brute_force(spark, cut):
    """Predicted positives (md5 top-n), or the highest scores when there are
    none; md5 top-n of the predicted negatives."""
    from pyspark.sql import functions as F
    from tabscore.plans import fixtures as fx
    o = fx.orders_t(spark, SF001).withColumn("prediction", (F.col("score") >= cut).cast("int"))
    rows = [(r.o_orderkey, r.prediction, r.score) for r in o.collect()]
    got = smp.fallback_sample(o, "prediction", "score", "done", 7, ["o_orderkey"])
    got = {(r.o_orderkey, r.group) for r in got.collect()}
    md5_top = lambda rs: [r[0] for r in sorted(rs, key=lambda r: (_md5(42, r[0]), r[0]))[:7]]
    want = {(k, "false") for k in md5_top([r for r in rows if r[1] == 0])}
    pos = [r for r in rows if r[1] == 1]
    if pos:
        want |= {(k, "true") for k in md5_top(pos)}
    else:
        top = sorted(rows, key=lambda r: (-r[2], _md5(42, r[0]), r[0]))[:7]
        want |= {(r[0], "high_prob_true") for r in top}
    assert got == want


def test_prepare_weights_from_training_rows(spark):
    """K5 in ``prepare``: positives weigh n_neg / n_pos of the training part,
    test rows have fold -1 and NULL labels are dropped."""
    from tabscore.operators import model as mdl
    from tabscore.plans import fixtures as fx
    o = fx.orders_t(spark, SF001).select("o_orderkey", "o_totalprice", "done")
    prep = mdl.prepare(o, "done", ["o_orderkey"], test_size=0.2, folds=3)
    rows = prep.select("label", "weight", "split", "fold").collect()
    assert len(rows) == o.where("done IS NOT NULL").count()
    tr = [r for r in rows if r["split"] == "train"]
    p = sum(r["label"] == 1.0 for r in tr)
    n = sum(r["label"] == 0.0 for r in tr)
    assert all(r["weight"] == pytest.approx(n / p) for r in rows if r["label"] == 1.0)
    assert {r["weight"] for r in rows if r["label"] == 0.0} == {1.0}
    assert {r["fold"] for r in rows if r["split"] == "test"} == {-1}
    assert {r["fold"] for r in tr} == {0, 1, 2}


def test_cuts_are_counted_in_one_group(spark, monkeypatch):
    """Rows are counted by class and cut, not by an aggregate for each cut; the rows are those of the whole order."""
    import hashlib

    from tabscore.plans import ranks

    def refused(*_):
        raise AssertionError("an aggregate for a cut")
    monkeypatch.setattr(ranks.F, "count_if", refused)
    rows = [(i, [True, False, None][i % 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y boolean").repartition(3)
    order = sorted(rows, key=lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest())
    for quota in ({(True,): 7, (False,): 30}, {(True,): 500, (False,): 1}):
        want = sorted(r[0] for (y,), n in quota.items() for r in [x for x in order if x[1] is y][:n])
        assert sorted(r.id for r in ranks.smallest_by_hash(df, quota, ["id"], class_cols=["y"]).collect()) == want
    assert sorted(r.id for r in ranks.smallest_by_hash(df, 25, ["id"]).collect()) == sorted(r[0] for r in order[:25])
    assert ranks.smallest_by_hash(df.where("id < 0"), 25, ["id"]).count() == 0
