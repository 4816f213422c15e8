"""SetSketch near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from tabscore.llm import near_documents as nd


def brute(rows, n, percent=80):
    def grams(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0D]+", low)
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), 10 ** 9), k)
    return sorted((k, len(s), low[find(i)], k == low[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def corpus(rng, families=12, alone=40):
    vocab = [f"w{i}" for i in range(500)] + ["É", "Ünd", "A1,"]
    rows = []
    for _ in range(alone):
        rows.append([rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 4, 50, 300]))])
    for _ in range(families):
        base = [rng.choice(vocab) for _ in range(rng.choice([60, 200, 600]))]
        for _ in range(rng.randint(2, 14)):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(w)
    rng.shuffle(rows)
    return [(i * 3 % 1009, rng.choice([" ", "\n", " \t"]).join(w).upper() if rng.random() < 0.3 else " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("n,block", [(4, 2048), (5, 3)])
def test_equals_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = corpus(random.Random(n)) + [(2000, None), (2001, "one two"), (2002, "ONE\ttwo"), (2003, "   ")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n long").repartition(6)
    got = sorted(tuple(r) for r in nd.near_documents(df, words=n).collect())
    assert got == brute(rows, n)


def test_hashes_count_distinct_shingles_and_registers_merge():
    rng = random.Random(1)
    for _, t in corpus(rng):
        for n in (1, 4, 5):
            assert len(nd.shingle_hashes(t, n)) == len(nd.shingle_set(t, n))
    a, b = (np.unique(np.random.default_rng(s).integers(0, 2 ** 64, 3000, np.uint64)) for s in (1, 2))
    assert (nd.merged(nd.registers(a), nd.registers(b)) == nd.registers(np.unique(np.concatenate([a, b])))).all()


def test_likelihood_estimate():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.3, 0.6, 0.8, 0.95):
        found = []
        for _ in range(60):
            pool = rng.integers(0, 2 ** 64, 4000, np.uint64)
            common = int(2000 * 2 * share / (1 + share))
            a, b = pool[:2000], pool[2000 - common:4000 - common]
            x, y = nd.registers(np.sort(a))[None], nd.registers(np.sort(b))[None]
            found.append(nd.likely(np.array([2000.0]), np.array([2000.0]), (x > y).sum(1), (x < y).sum(1))[0])
        assert abs(np.mean(found) - share) < 0.03


@pytest.mark.parametrize("ratio", [1.0, 0.97, 0.95, 0.9, 0.85, 0.801])
def test_estimate_loses_less_than_the_bands(ratio):
    """Chance of all outcomes of the registers, for sets of resemblance 0.8, that ``plausible`` drops."""
    from math import lgamma, log, log1p
    r, u = nd.REGISTERS, ratio / (1 + ratio)
    up, down = (-log1p(-x * (nd.BASE - 1) / nd.BASE) / log(nd.BASE) for x in (max(u - (1 - u) * 0.8, 1e-12), 1 - u - u * 0.8))
    above, below = (x.ravel() for x in np.indices((r + 1, r + 1)))
    above, below = above[above + below <= r], below[above + below <= r]
    chance = [lgamma(r + 1) - lgamma(i + 1) - lgamma(j + 1) - lgamma(r - i - j + 1) + i * log(up) + j * log(down) + (r - i - j) * log(1 - up - down)
              for i, j in zip(above.tolist(), below.tolist())]
    at = np.arange(r)[None, :]
    a = np.where(at < above[:, None], 2, 1)
    b = np.where((at >= above[:, None]) & (at < (above + below)[:, None]), 2, 1)
    size = np.full(len(above), 1_000_000)
    kept = nd.plausible((size * ratio).astype(int), size, a, b, 0.8)
    assert np.exp(chance)[~kept].sum() < 1e-7


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "x"), (2, "a b c d e f", "y"),
                                (3, "q r s t u v", "y"), (3, "a b c d e f", "y"), (4, "q r s t u v", "y")], "doc_id long, text string, kept string")
    got = {(r.doc_id, r.component_id) for r in nd.near_documents(df).collect()}
    assert got == {(None, None), (1, 1), (2, 1), (3, 1), (4, 1)}
    left = nd.drop_copies(df)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "None"]
    assert nd.near_documents(df.limit(0)).count() == 0 and nd.drop_copies(df.limit(0)).count() == 0


def test_null_ids_stay(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (None, text), (2 ** 60 + 1, text), (2 ** 60 + 3, text + " eleven"), (None, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in nd.near_documents(docs, words=4).collect()), key=str)
    want = [(None, 7, None, True)] * 2 + [(None, 0, None, True), (2 ** 60 + 1, 7, 2 ** 60 + 1, True), (2 ** 60 + 3, 8, 2 ** 60 + 1, False), (5, 0, 5, True)]
    assert got == sorted(want, key=str)
    assert nd.drop_copies(docs, 4).count() == 5
