"""Cross-tokenizer alignment against a plain version that encodes whole texts and counts all links one at a time."""

import hashlib
from collections import Counter

import pytest

from tabscore.llm import token_alignment as ta
from tests.conftest import SF001

ODD = [None, "", " ", "  ", "\n", "a", "a ", " a  b\n\n c\t d\n\te \n", "x▁y z", "▁", "it's we'll don't  ", "日本語 テスト。naïve café́ 😀👍🏽", "<|endoftext|> and <s> </s> <unk> <0x41>", "a\tb c　d\x1ce\x85f",
       "tab\t", "z" * 3000, "word " * 4000, "\r\nline\r\n", "0123 4567890.5 %%% ###", " x  y", "a\x00b", "ééé" * 200 + "\n" + "語" * 300, "same words here", "same words here"]


@pytest.fixture(scope="module")
def own():
    return ta.Aligner(*ta.default_tokenizers())


def plain(texts, own):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest; and the documents of every pair."""
    per = []
    for t in texts:
        groups = []
        if t:
            data = (" " + t).encode()
            a, b = own.a.encode(" " + t, add_special_tokens=False).ids, own.b.encode(t)
            if b"".join(own.a_bytes[i] for i in a) == data == b"".join(own.b_bytes[i] for i in b):
                def ends(ids, size):
                    out, at = [], 0
                    for i in ids:
                        at += len(size[i])
                        out.append(at)
                    return out
                ea, eb = ends(a, own.a_bytes), ends(b, own.b_bytes)
                for cut in sorted(set(ea) & set(eb)):
                    low = groups[-1][2] if groups else 0
                    groups.append(([x for x, e in zip(a, ea) if low < e <= cut], [x for x, e in zip(b, eb) if low < e <= cut], cut))
        per.append(groups)
    links = [Counter((x, y) for a, b, _ in g for x in a for y in b) for g in per]
    docs = Counter(p for c in links for p in c)
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for g, c in zip(per, links):
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b, _ in g)
        out.append((sum(len(a) for a, _, _ in g), sum(len(b) for _, b, _ in g), len(g), sum(c.values()), sum(n for p, n in c.items() if docs[p] == best[p[0]]),
                    sum(n * docs[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return out, docs


def test_odd_texts_equal_plain_version(spark, own):
    rows = [(i if i % 7 else None, t, i, "x") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, slice string").repartition(3)
    out, pairs = ta.align(docs, *ta.default_tokenizers())
    want, counts = plain(ODD, own)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(str((i if i % 7 else None, *w)) for i, w in enumerate(want))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(counts)
    zeros = {t for t, w in zip(ODD, want) if w[2] == 0}
    assert {None, "", "▁", "x▁y z"} <= zeros and "a\x00b" not in zeros


def test_given_documents_equal_plain_version(spark, own):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = ta.op12_token_alignment(spark, SF001)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, _ = plain(list(texts.values()), own)
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == dict(zip(texts, want))
    assert sum(w[2] > 0 for w in want) > 0.9 * len(want)


def test_slices_and_forgetting_change_nothing(spark, own, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    whole = sorted(map(str, ta.align(docs, *ta.default_tokenizers())[0].collect()))
    texts = [t or "" for t in ODD]
    monkeypatch.setattr(ta, "REMEMBERED", 2)
    one = [ta.aligned(own, [t]) for t in texts for _ in range(2)][::2]
    every = ta.aligned(own, texts)
    assert [s["shas"][0] for s in one] == every["shas"]
    assert sorted(map(str, ta.align(docs.repartition(len(ODD)), *ta.default_tokenizers())[0].collect())) == whole


def test_map_and_empty_table(spark, own):
    hit = [(a, b) for a, b in enumerate(own.same) if b >= 0]
    assert len(hit) > 5000 and all(own.a_bytes[a] == own.b_bytes[b] for a, b in hit)
    none = spark.createDataFrame([], "doc_id long, text string")
    out, pairs = ta.align(none, *ta.default_tokenizers())
    assert out.count() == 0 and pairs.count() == 0
