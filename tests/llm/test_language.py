"""Forward-backward against enumeration; held-out accuracy; defined results."""

import itertools
import zlib

import numpy as np

from tabscore.llm import language_crf as crf


def test_forward_backward_equals_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    for segment in (1, 2, 3, 64):
        monkeypatch.setattr(crf, "SEGMENT", segment)
        sizes, L = [1, 5, 3, 7], 3
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        emit, first, trans = rng.normal(size=(sum(sizes), L)), rng.normal(size=L), rng.normal(size=(L, L))
        post, pairs = crf.forward_backward(emit, starts, first, trans)
        want, want_pairs = np.zeros_like(emit), np.zeros((L, L))
        for s, n in zip(starts, sizes):
            paths = list(itertools.product(range(L), repeat=n))
            w = np.exp([first[p[0]] + sum(emit[s + i, y] for i, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
            w /= w.sum()
            for p, x in zip(paths, w):
                for i, y in enumerate(p):
                    want[s + i, y] += x
                for a, b in zip(p, p[1:]):
                    want_pairs[a, b] += x
        assert np.allclose(post, want) and np.allclose(pairs, want_pairs)


def test_mixed_text_is_labelled_word_by_word():
    samples = [("the house and the river with thing", "en"), ("der Fluss und das Haus nicht mit", "de")] * 20
    model = crf.fit(samples)
    out = model.label_words("the river and the house 12 der Fluss und das Haus")
    assert [x[1] for x in out] == ["en"] * 5 + ["de"] * 5
    assert model.predict(["", "12 .", "the house"])[0][:2] == ("und", 0.0)
    assert model.predict(["² ½ _ Ⅷ"])[0][:2] == ("und", 0.0)
    assert model.predict(["12 ."])[0][:2] == ("und", 0.0) and model.predict(["the house"])[0][0] == "en"
    model.remembered = 1
    assert [x[1] for x in model.label_words("the river and the house")] == ["en"] * 5


def test_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = crf.learn(docs)
    got = {r.doc_id: r for r in crf.identify(docs, model).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    # neither lang nor source nor id changes a prediction
    again = crf.identify(docs.selectExpr("doc_id", "text", "'xx' as lang"), model)
    assert {r.doc_id: r.lang_pred for r in again.collect()} == {k: r.lang_pred for k, r in got.items()}


def test_edges(spark):
    df = spark.createDataFrame([(1, "the house", "en", "s"), (None, "the house", "de", "s"), (3, None, "en", "s"), (4, "", None, "s"),
                                (4, "", None, "s"), (5, "%% 12", "en", "s"), (6, "das Haus " * 20000, "de", "s"), (8, "das Haus", "de", "s")],
                               "doc_id long, text string, lang string, score string")
    out = crf.identify(df, crf.learn(df)).collect()
    assert len(out) == 8 and sum(r.lang_pred == "und" for r in out) == 4 and all(0 <= r.score <= 1 for r in out)
    kept = crf.keep_known(df, crf.learn(df))
    assert kept.columns == df.columns and kept.count() == 4
    empty = crf.learn(df.limit(0))
    assert crf.identify(df.limit(0), empty).count() == 0
    assert {r.lang_pred for r in crf.identify(df, empty).collect()} == {"und"}


def test_every_language_is_learned(spark):
    """Languages of a few long texts beside one of many short ones."""
    rows, i = [], 0
    for k in range(8):
        word = "".join(chr(97 + (k * 5 + j) % 26) for j in range(4))
        for _ in range(2):
            while zlib.crc32(str(i).encode()) % 4 == 2:
                i += 1
            rows.append((i, (word + " ") * 6000, f"l{k}"))
            i += 1
    rows += [(1000 + j, "many short ones", "en") for j in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crf.learn(docs, chars=3000)
    assert model.labels == sorted({r[2] for r in rows})
    assert {r.doc_id: r.lang_pred for r in crf.identify(docs.where("doc_id < 1000"), model).collect()} == {r[0]: r[2] for r in rows if r[0] < 1000}


def test_learning_holds_few_words_at_once(spark, monkeypatch):
    """The driver looks at bounded runs of sequences, with the same weights, and gives their memory back; before, at all words at once."""
    rng = np.random.default_rng(7)
    words = {"en": ["the", "house", "river", "with", "thing"], "de": ["der", "Fluss", "nicht", "und", "Haus"]}
    rows = [(i, "\n".join(" ".join(rng.choice(words[x], 6)) for _ in range(9)), x) for i in range(40) for x in ("en", "de")]
    samples, seen, given = [(t, x) for _, t, x in rows], [], []
    run = crf.forward_backward
    monkeypatch.setattr(crf, "forward_backward", lambda emit, *a: seen.append(len(emit)) or run(emit, *a))
    monkeypatch.setattr(crf, "AT_ONCE", 1 << 20)
    whole = crf.fit(samples, rounds=3)
    assert set(seen) == {80 * 54}
    seen.clear()
    monkeypatch.setattr(crf, "AT_ONCE", 100)
    parts = crf.fit(samples, rounds=3)
    assert sum(seen) == 3 * 80 * 54 and max(seen) < 100 + 2 * 48
    assert all(np.allclose(a, b, rtol=1e-6, atol=1e-9) for a, b in ((whole.weights, parts.weights), (whole.first, parts.first), (whole.trans, parts.trans)))
    monkeypatch.setattr(crf, "give_back", lambda: given.append(1))
    crf.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert given
