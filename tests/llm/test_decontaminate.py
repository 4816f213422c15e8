"""Containment search against brute force and against its SQL."""

import random
import re

import duckdb

from tabscore.llm import decontaminate as dc


def brute(docs, items, n=5, share=0.8):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    grams = {}
    for k, t in items:
        w = words(t)
        if w and k is not None:
            m = min(n, len(w))
            grams.setdefault(k, set()).update((m, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    out = []
    for k, t in docs:
        w = words(t)
        have = {(m, tuple(w[i:i + m])) for m in range(1, n + 1) for i in range(len(w) - m + 1)}
        hit = sorted(i for i, g in grams.items() if len(g & have) / len(g) >= share - 1e-9)
        out.append((k, len(hit), hit, not hit))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)] + ["É", "x-y", "Don't"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 5, 6, 12, 40])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "..."), (None, "w1 w2 w3 w4 w5"), (7, items[9][1])]
    docs = []
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 30, 400]))]
        for _ in range(rng.randint(0, 3)):
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(vocab)
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper()))
    docs += [(500, None), (501, ""), (None, items[3][1]), (None, "w1"), (3, docs[3][1]), (3, "other")]
    d = spark.createDataFrame([(k, t, "z") for k, t in docs], "doc_id long, text string, item_id string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_items, r.item_ids, r.kept) for r in dc.per_document(d, b).collect()), key=str)
    assert got == brute(docs, items)
    left = dc.clean(d, b)
    assert left.columns == d.columns and left.count() == sum(x[3] for x in got)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.per_document(d.limit(0), b).count() == 0
    assert [r.kept for r in dc.per_document(d, b.limit(0)).collect()] == [True]
    assert [r.kept for r in dc.per_document(d, b).collect()] == [False]


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = sorted(con.execute(dc.ORACLE["op6_decontaminate"]).fetchall())
    got = sorted(tuple(r) for r in dc.op6_decontaminate(spark, sf).collect())
    assert got == want and any(not r[4] for r in got)
