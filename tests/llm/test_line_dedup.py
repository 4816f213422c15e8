"""The edit join and the removal against brute force."""

import random

import pytest

from tabscore.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, edits, min_chars, most=None):
    """Texts after removal, by definition."""
    occ = [(k, p, line.strip(" ")) for k, t in rows if t is not None for p, line in enumerate(t.split("\n")) if len(line.strip(" ")) >= min_chars]
    texts = sorted({o[2] for o in occ})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                root[find(a)] = find(b)
    first, own = {}, {}
    for k, p, t in sorted(occ, key=lambda o: (o[0] is not None, o[0] or 0, o[1])):
        first.setdefault(find(t), k)
        own.setdefault((k, find(t)), p)
    out = []
    for k, t in rows:
        if t is None:
            out.append((k, None))
            continue
        parts = t.split("\n")
        within, abroad, chars = set(), set(), 0
        for p, line in enumerate(parts):
            s = line.strip(" ")
            if len(s) >= min_chars:
                if own[(k, find(s))] != p:
                    within.add(p)
                elif first[find(s)] != k:
                    abroad.add(p)
                    chars += len(s)
        gone = within if most is not None and chars > len(t) * most else within | abroad
        out.append((k, "\n".join(x for p, x in enumerate(parts) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("edits,most,crowd", [(2, None, 50), (2, None, 1), (1, 0.5, 3), (3, None, 50)])
def test_equals_brute_force(spark, monkeypatch, edits, most, crowd):
    monkeypatch.setattr(ld, "CROWD", crowd)
    rng = random.Random(edits)
    letters = "abcdé ñ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(8, 40))) for _ in range(25)]

    def vary(s):
        s = list(s)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
            at, what = rng.randint(0, len(s)), rng.random()
            if what < 0.4 or not s:
                s.insert(at, rng.choice(letters))
            elif what < 0.7:
                s.pop(min(at, len(s) - 1))
            else:
                s[min(at, len(s) - 1)] = rng.choice(letters)
        return "".join(s)
    rows = [(i, "\n".join(rng.choice(["", " ", "x"]) if rng.random() < 0.2 else vary(rng.choice(base)) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, base[0] + "\n" + base[1]), (103, (base[2] + "\n") * 200)]
    df = spark.createDataFrame([(k, t, "q", 7) for k, t in rows], "doc_id long, text string, doc string, n_lines int").repartition(5)
    out = ld.dedup_lines(df, edits=edits, min_chars=10, most=most)
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == ["doc_id", "text", "doc"]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == brute(rows, edits, 10, most)


def test_segments_are_even_and_whole(spark):
    df = spark.range(6, 60).selectExpr("cast(id as int) as n")
    from pyspark.sql import functions as F
    for edits in (1, 2, 3):
        cols = [c for i in range(edits + 1) for c in ld.segment(F.col("n"), i, edits)]
        for r in df.select("n", *[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect():
            at = 1
            for i in range(edits + 1):
                assert r[f"c{2 * i}"] == at
                at += r[f"c{2 * i + 1}"]
            assert at == r.n + 1


def test_repeated_rows_and_empty(spark):
    line = "a line that is long enough to take part"
    df = spark.createDataFrame([(1, line), (1, line), (2, line + "\nshort")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in ld.dedup_lines(df).collect()) == [(1, line), (1, line), (2, "short")]
    assert ld.dedup_lines(df.limit(0)).count() == 0


def test_short_lines_take_part(spark):
    """Equal lines of any length go; two edits count from three characters on; blank lines stay."""
    rows = [(1, "To\n\nAll rights reserved.\nOf, edti oner."), (2, "To\n \nAll rights reserved\nof\n"), (3, "Of, edti onr.\nQuite another one\n\nQ"), (4, "Q")]
    got = dict(tuple(r) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got == {1: rows[0][1], 2: " \nof\n", 3: "Quite another one\n\nQ", 4: ""}


def test_short_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ld, "CROWD", 3)
    rng = random.Random(4)
    rows = [(i, "\n".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.choice([0, 3, 5, 6, 7, 8, 9, 10]))) for _ in range(8))) for i in range(40)]
    out = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == brute(rows, 2, 1)


def test_text_is_split_once(spark):
    """Inside a transform the text would be split again for every line that stays."""
    docs = spark.createDataFrame([(1, "abcdefgh one\nabcdefgh two"), (2, "abcdefgh one\nother")], "doc_id long, text string")
    out = ld.dedup_lines(docs)
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.text for r in out.collect()} == {1: "abcdefgh one\nabcdefgh two", 2: "other"}


def test_keys_of_lone_lines_are_not_moved_again(spark, monkeypatch):
    """Only lines that share a key with another line leave the first count of the keys; before, all keys were dealt out twice."""
    kept = []
    keep = ld.keep
    monkeypatch.setattr(ld, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcdefghijé") for _ in range(60))) for i in range(40)]
    rows += [(100, rows[0][1][:-1]), (101, rows[0][1] + "é")]
    lines = ld.lines_of(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 1)
    found = ld.matches(lines, 2)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    near = {r.a for r in lines.where("doc in (0, 100, 101)").collect()}
    assert {x for r in found.collect() for x in (r.u, r.v)} == near and found.count() == 3
    assert 0 < sum(df.count() for df in kept) <= 3 * 12 * 2


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_keys_are_hashes_of_characters(spark, edits):
    """An own segment's key is one of the probe keys of a line up to the edits longer, whether characters are bytes or not."""
    from pyspark.sql import functions as F
    for line in ("segments of a line", "sègments of à line", "abcdé", "x" * 30):
        longer = ["é" * k + line for k in range(edits + 1)] + [line + "z" * edits, line[:3] + "y" * edits + line[3:]]
        df = spark.createDataFrame([(i, x) for i, x in enumerate([line, *longer])], "a long, line string")
        rows = ld.keys(df, edits).collect()
        own = {r.k for r in rows if r.a == 0 and r.own}
        assert len(own) == edits + 1
        for i in range(1, len(longer) + 1):
            assert own & {r.k for r in rows if r.a == i}
        n, size = len(line), len(line) // (edits + 1)
        first = df.where("a = 0").select(F.xxhash64(F.lit(0), F.lit(n), F.substring("line", 1, size))).first()[0]
        assert first in own
