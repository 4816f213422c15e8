"""Prefix trie against a plain version on nested dictionaries, with and without upper nodes; double arrays; odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tabscore.llm import prefix_trie as pt
from tests.conftest import SF001


def plain(rows):
    """Nodes of ``(conv_id, turn, role, text)`` rows, one conversation at a time."""
    own = {}
    for c, at, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((at is not None, at or 0, mark), mark, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    own = {c: [x[1:] for x in sorted(t)] for c, t in own.items()}
    nodes, ends, words = {}, {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        seq = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            path = tuple(t for t, _ in seq[:d])
            nodes.setdefault(path, set()).add(c)
            words[path] = seq[d - 1][1] if d else 0
        ends.setdefault(tuple(t for t, _ in seq), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if p in kids else 1
        saved[p] = (len(nodes[p]) - 1) * words[p] + sum(saved[k] for k in kids.get(p, []))
    return sorted((min(m), len(p), -1 if not p else min(nodes[p[:-1]]), len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in nodes.items())


def result(df, **more):
    return sorted((*(-1 if x is None else x for x in tuple(r)[:3]), *tuple(r)[3:]) for r in pt.trie(df, **more).collect())


SHAPE = "conv_id long, turn long, role string, text string"


def made(seed=1):
    """Conversations that share turns: copies, prefixes of each other, one long one, repeated and null turns."""
    rnd, rows = random.Random(seed), []
    for c in range(90):
        n = rnd.choice([0, 1, 2, 3, 5, 7]) if c != 44 else 60
        for i in range(max(n, 1)):
            rows.append((c, i, "user" if i % 2 == 0 else "assistant", f"t{rnd.randint(0, 1 if i < 3 else 2)} word\tmore  {'x ' * (i % 3)}"))
    rows += [(c, i, "user", f"same {i} here") for c in range(200, 260) for i in range(4)]
    rows += [(7, None, None, None), (7, None, "user", ""), (7, 0, "a", "tie"), (7, 0, "b", "tie"), (None, 1, "user", "lost"), (305, 0, "user", "alone"), (-3, 0, "user", "t0 word")]
    rows += [(7, 0, "a", "tie")]
    return rows


@pytest.mark.parametrize("shard", [3, 40, 10_000])
def test_equals_plain_version(spark, shard):
    rows = [r for r in made() if r[0] is None or r[0] >= 0]
    assert result(spark.createDataFrame(rows, SHAPE).repartition(5), shard=shard) == plain(rows)


def test_given_table_equals_plain_version(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    out = pt.op13_prefix_trie(spark, SF001)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted((*(-1 if x is None else x for x in tuple(r)[:3]), *tuple(r)[3:]) for r in out.collect())
    assert got == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_double_array_walks_its_sequences():
    rnd = random.Random(2)
    seqs = sorted({tuple(rnd.randint(1, rnd.choice([3, 400])) for _ in range(rnd.randint(1, 6))) for _ in range(700)})
    trie = pt.DoubleArray.pack(seqs)
    sizes = np.array([len(s) for s in seqs])
    flat = np.array([c for s in seqs for c in s])
    seen = {}
    for level, who, t in trie.walk(flat, sizes):
        for i, state in zip(who.tolist(), t.tolist()):
            assert seen.setdefault(state, seqs[i][:level + 1]) == seqs[i][:level + 1]
    prefixes = {s[:k] for s in seqs for k in range(1, len(s) + 1)}
    assert set(seen.values()) == prefixes and int((trie.check >= 0).sum()) == len(prefixes)
    with pytest.raises(KeyError):
        list(trie.walk(np.array([999]), np.array([1])))
    assert len(trie.check) < 3 * len(prefixes) + 400


def test_ids_at_a_node_in_many_texts(spark, monkeypatch):
    monkeypatch.setattr(pt, "JOINED", 50)
    rows = [(c, i, "user", f"same {i}") for c in range(0, 600) for i in range(4)]
    df = spark.createDataFrame(rows, SHAPE).repartition(7)
    assert result(df) == plain(rows) and result(df, shard=1) == plain(rows)


def test_odd_tables(spark):
    assert pt.trie(spark.createDataFrame([], SHAPE)).count() == 0
    assert pt.trie(spark.createDataFrame([(None, 1, "user", "x")], SHAPE)).count() == 0
    # 25's own turns go with its head and 20 is absent: only the root is left (crc32("25") % 4 = 1)
    assert zlib.crc32(b"25") % 4 == 1
    only = [(25, 0, "user", "gone")]
    assert result(spark.createDataFrame(only, SHAPE)) == plain(only) and len(plain(only)) == 1
    long_ = [(3, 0, "user", "w " * 300_000), (4, 0, "user", "w " * 300_000), (9, 0, "user", "")]
    wide = spark.createDataFrame([(*r, 1, 2, "c") for r in long_], SHAPE + ", c long, depth long, x1 string")
    assert result(wide) == plain(long_)
