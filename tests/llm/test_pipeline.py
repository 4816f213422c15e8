"""The pipeline's stages on planted cases, and over a given table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tabscore.llm import line_dedup, near_copies

from .test_line_dedup import brute as lines_brute
from .test_near_documents import brute as near_brute
from .test_near_documents import corpus


def words(rng, n):
    return " ".join(rng.choice(["the", "and", "with"]) if rng.random() < 0.3 else "".join(rng.choice("thingeraosl") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_planted_cases(spark, tmp_path):
    rng = random.Random(6)
    item = words(rng, 40)
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    boiler = words(rng, 12)
    clean = {i: "\n".join(words(rng, 30) for _ in range(5)) for i in range(20)}
    rows = dict(clean)
    rows[100] = clean[3]                                                    # exact copy
    rows[101] = clean[4].replace(clean[4].split()[70], "changed", 1)        # near copy
    rows[102] = words(rng, 100) + " " + item + " " + words(rng, 100)        # leak
    rows[103], rows[104], rows[105] = None, "", "12 %% 34"                  # no language
    for i in (6, 7, 8):
        rows[i] = boiler + "\n" + rows[i] + "\n" + boiler
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"out-{name}")
        out.write.parquet(path)
        if name != "tokens":
            assert out.columns == docs.columns
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    ids = {n: {r.doc_id for r in rows_} for n, rows_ in seen.items()}
    assert ids["language"] == set(rows) - {103, 104, 105}
    texts = {r.doc_id: r.text for r in seen["lines"]}
    assert texts[6] == boiler + "\n" + clean[6] and texts[7] == clean[7] and texts[8] == clean[8] and texts[100] == clean[3]
    assert ids["copies"] == ids["language"] - {100, 101}
    assert ids["leaks"] == ids["tokens"] == ids["copies"] - {102} and all(r.round_trip and r.parity for r in seen["tokens"])


def stages(spark, tmp_path, rows, names):
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name in names:
        dict(cp.STAGES)[name](spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"only-{name}"))
        docs = spark.read.parquet(str(tmp_path / f"only-{name}"))
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    return seen


def test_short_document_made_of_repeated_passages(spark, tmp_path):
    """No document holds most of it, but its lines stand in several: it is no copy and loses them."""
    rng = random.Random(8)
    passages = [words(rng, 60) for _ in range(2)]
    rows = {i: "\n".join(words(rng, 30) for _ in range(8)) for i in range(6)}
    rows[2] += "\n" + passages[0]
    rows[4] += "\n" + passages[1]
    own = words(rng, 12)
    rows[20] = passages[0] + "\n" + own + "\n" + passages[1]
    seen = stages(spark, tmp_path, rows, ["lines", "copies"])
    assert seen["lines"] == seen["copies"] == rows | {20: own}


def test_copy_with_a_word_changed_in_most_lines(spark, tmp_path):
    """Its unchanged lines are less than half of it; they must not go before the copy is found."""
    rng = random.Random(10)
    base = [words(rng, 60) for _ in range(6)]
    changed = [" ".join("rewritten" if i == 30 else w for i, w in enumerate(line.split())) if p < 4 else line for p, line in enumerate(base)]
    rows = {1: words(rng, 80), 2: "\n".join(base), 3: "\n".join(changed), 4: words(rng, 80)}
    seen = stages(spark, tmp_path, rows, ["lines", "copies"])
    assert seen["lines"] == rows and seen["copies"] == {i: rows[i] for i in (1, 2, 4)}


def test_lines_and_copies_equal_brute_force(spark, tmp_path):
    """Near copies with a word changed in no, one or most lines, among texts that share passages."""
    rng = random.Random(12)
    shared = [words(rng, 12) for _ in range(6)]
    texts = []
    for _ in range(12):
        base = [rng.choice(shared) if rng.random() < 0.3 else words(rng, rng.choice([10, 40])) for _ in range(rng.randint(2, 9))]
        for _ in range(rng.choice([1, 1, 2, 3])):
            most = rng.choice([0.0, 0.2, 0.8])
            parts = [line.split() for line in base]
            for w in parts:
                if rng.random() < most:
                    w[rng.randrange(len(w))] = "rewritten"
            texts.append("\n".join(map(" ".join, parts)))
    rng.shuffle(texts)
    rows = list(enumerate(texts))

    def grouped(rows):
        return {k: root for k, _, root, _ in near_brute(rows, 5)}
    root = grouped(rows)
    several = {c for c in root.values() if list(root.values()).count(c) > 1}
    assert len(several) >= 3
    after = dict(lines_brute([r for r in rows if root[r[0]] not in several], 2, line_dedup.MIN_CHARS)) | {k: t for k, t in rows if root[k] in several}
    again = grouped(sorted(after.items()))
    left = dict(lines_brute([(k, t) for k, t in sorted(after.items()) if again[k] == k], 2, line_dedup.MIN_CHARS))
    seen = stages(spark, tmp_path, dict(rows), ["lines", "copies"])
    assert seen["lines"] == after and seen["copies"] == left


@pytest.mark.parametrize("crowd", [10_000, 2])
def test_near_copies_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    rows = corpus(random.Random(3)) + [(2000, None), (2001, "one two"), (2002, "ONE\ttwo"), (2003, "   "), (2004, "   ")]
    size = {}
    for _, _, root, _ in near_brute(rows, 5):
        size[root] = size.get(root, 0) + 1
    want = {k for k, _, root, _ in near_brute(rows, 5) if size[root] > 1}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    near = near_copies.near_copies(df)
    got = {r.doc_id for r in df.join(near, F.xxhash64("text") == F.col("_near")).collect() if r.text and r.text.strip()}
    assert got == want if crowd > 2 else got >= want


def test_lines_of_a_copy_that_goes_are_not_lost(spark, tmp_path):
    """A copy's own line stays in the document that has it too; the one of the group that stays loses what others had before."""
    rng = random.Random(9)
    long = [words(rng, 40) for _ in range(12)]
    only, common = words(rng, 10), words(rng, 8)
    rows = {1: words(rng, 50) + "\n" + common, 2: "\n".join([*long, common]), 3: "\n".join([*long, only, common]), 4: words(rng, 50) + "\n" + only}
    seen = stages(spark, tmp_path, rows, ["lines", "copies"])
    assert seen["lines"] == rows
    assert seen["copies"] == {1: rows[1], 2: "\n".join(long), 4: rows[4]}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_lone_lines_are_not_stored(spark, monkeypatch):
    """Lines and keys that no other line shares take no room in the shared folder; before, every distinct line was kept."""
    kept = []
    keep = line_dedup.keep
    monkeypatch.setattr(line_dedup, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    rng = random.Random(12)
    rows = [(i, "\n".join("".join(rng.choice("abcdefghijklmno ") for _ in range(50)) for _ in range(4))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = cp.copies(spark, df, "")
    assert sorted(tuple(r) for r in out.select("doc_id", "text").collect()) == rows
    assert kept and sum(x.count() for x in kept) == 0


@pytest.mark.parametrize("crowd", [20, 2])
def test_near_copies_are_no_others(spark, monkeypatch, crowd):
    """Members of crowded bands are decided as well: texts that share a passage are no near copies, however many have it."""
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    rng = random.Random(5)
    passage = words(rng, 60)
    rows = corpus(random.Random(3)) + [(3000 + i, passage + " " + words(rng, rng.choice([5, 12, 12, 30]))) for i in range(60)]
    rows += [(4000 + i, rows[-1 - i][1] + " other") for i in range(5)] + [(5000, rows[-8][1])]
    size = {}
    for _, _, root, _ in near_brute(rows, 5):
        size[root] = size.get(root, 0) + 1
    want = {k for k, _, root, _ in near_brute(rows, 5) if size[root] > 1}
    assert 10 < len([k for k in want if 3000 <= k < 4000]) < 55
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    near = near_copies.near_copies(df)
    got = {r.doc_id for r in df.join(near, F.xxhash64("text") == F.col("_near")).collect() if r.text and r.text.strip()}
    assert got == want


def test_crowded_texts_lose_their_lines(spark, monkeypatch):
    """Forty texts share a passage and are near copies of none: the lines stage takes it out of all but the first."""
    monkeypatch.setattr(near_copies, "CROWD", 2)
    rng = random.Random(15)
    passage = words(rng, 40)
    rows = {i: passage + "\n" + words(rng, 24) for i in range(40)}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id: r.text for r in cp.lines(spark, docs, "").collect()} == dict(lines_brute(list(rows.items()), 2, line_dedup.MIN_CHARS))
