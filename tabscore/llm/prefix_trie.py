"""Prefix trie of conversations in double arrays.

A conversation is its turns in their order.  Conversations that begin with the same turns share nodes; a node says how many
conversations pass it, how many nodes hang below it, and how many words a store saves that keeps each shared turn once.

Method: every prefix has a 128-bit fingerprint (two running XORs of hashes of depth and turn), so equal conversations are
one sequence before any trie is built.  A node with more than ``SHARD_TURNS`` turns below it is an upper node; a sequence
belongs to the shard of its first node that is none.  Shards are dealt to bins of about that many turns; a bin packs
its sequences into BASE and CHECK arrays over dense turn ids and walks them for its nodes.  What shards hand up is merged
at the upper nodes and carried to the root in rounds of pointer doubling (a logarithm of their depth).

No conversation, copy group or first turn meets in one task: positions come from range-partitioned rows with offsets of
the cells before; the ids that end at a node are joined to texts of bounded length where they lie, and one task only streams
those texts through the digest.

Defined results: rows without a conversation id are ignored; null roles and texts are empty; turns stand in the order of
``turn`` (null first), those with equal ``turn`` in the order of the md5 of role and text; repeated rows are repeated turns;
conversations without turns are members of the root alone; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscore.llm.common import keep, read

#: Turns below a node from which on it is an upper node; a bin's size in turns.
SHARD_TURNS = 20_000
#: Upper nodes (four numbers each) up to which they are sent to all executors.
BROADCAST_ROWS = 500_000
#: Characters of joined ids that travel as one row.
JOINED = 60_000
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "x1", "x2"]


def small(df: DataFrame) -> DataFrame:
    """``df`` (kept before), marked for broadcast if its counted rows are few; else the join's hot nodes are left to AQE."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def marks(depth: Column, turn: Column) -> list[Column]:
    """Two hashes of a turn at a depth; a prefix's fingerprint is their XOR over its turns."""
    return [F.xxhash64(F.lit(17), depth, turn).alias("f1"), F.xxhash64(turn, depth, F.lit(29)).alias("f2")]


# ---- sequences -----------------------------------------------------------------------------------------------------

def later_cells(cells: DataFrame, *values: Column) -> DataFrame:
    """For each (part, c) that isn't the first of its c, the values aggregated over the cells before.  Parts are ranges, so
    there are fewer such cells than parts and they can be broadcast."""
    names = [f"b{i}" for i in range(len(values))]
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    out = cells.select("part", "c", F.count("*").over(before).alias("_earlier"), *[v.over(before).alias(n) for v, n in zip(values, names)])
    return F.broadcast(out.where("_earlier > 0").drop("_earlier"))


def positions(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their place: c, k (from 0), turn id (md5 of role and text), words, part."""
    said = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text)]
    rows = df.select(F.col(key).cast("long").alias("c"), F.col(turn).alias("at"), F.unhex(F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said).cast("binary"))).alias("t"),
                     F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words")).where("c is not null")
    order = [F.col("c"), F.col("at").asc_nulls_first(), F.col("t")]
    parts = keep(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    offsets = later_cells(parts.groupBy("part", "c").agg(F.count("*").alias("n")), F.sum("n"))
    inside = F.row_number().over(Window.partitionBy("part", "c").orderBy(*order[1:])) - 1
    return keep(parts.withColumn("k", inside).join(offsets, ["part", "c"], "left")
                .select("part", "c", (F.col("k") + F.coalesce("b0", F.lit(0))).alias("k"), "t", "words"))


def rebuilt(rows: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(conversations, turns)``: the first crc32(id) % ``most`` turns of each conversation are those of the first of its
    ``group`` ids.  Turns: c, depth (from 1), t, words, part and the fingerprint x1, x2; conversations: c."""
    taken = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most))
    heads = rows.where((F.col("c") % group == 0) & (F.col("k") < most - 1)).select(F.col("c").alias("b"), (F.col("k") + 1).alias("depth"), "t", "words")
    convs = rows.select("c").distinct().select("c", taken.alias("h"), (F.col("c") - F.col("c") % group).alias("b"))
    first = convs.join(heads, "b").where(F.col("depth") <= F.col("h"))
    first = keep(first.select("c", "depth", "t", "words", *marks(F.col("depth"), F.col("t"))))
    so_far = Window.partitionBy("c").orderBy("depth")  # at most most - 1 rows
    head_rows = first.select("c", "depth", "t", "words", F.bit_xor("f1").over(so_far).alias("x1"), F.bit_xor("f2").over(so_far).alias("x2"))
    ends = convs.join(first.groupBy("c").agg(F.count("*").alias("m"), F.bit_xor("f1").alias("h1"), F.bit_xor("f2").alias("h2")), "c", "left").na.fill(0)
    own = rows.join(ends.select("c", "h", "m", "h1", "h2"), "c").where(F.col("k") >= F.col("h"))
    own = own.withColumn("depth", F.col("k") - F.col("h") + F.col("m") + 1)
    own = own.select("part", "c", "depth", "t", "words", "h1", "h2", *marks(F.col("depth"), F.col("t")))
    cells = own.groupBy("part", "c").agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"))
    so_far = Window.partitionBy("part", "c").orderBy("depth")
    run = own.select("part", "c", "depth", "t", "words", "h1", "h2", F.bit_xor("f1").over(so_far).alias("r1"), F.bit_xor("f2").over(so_far).alias("r2"))
    run = run.join(later_cells(cells, F.bit_xor("f1"), F.bit_xor("f2")), ["part", "c"], "left").na.fill(0, ["b0", "b1"])
    own_rows = run.select("c", "depth", "t", "words", *[F.col(f"h{i + 1}").bitwiseXOR(F.col(f"r{i + 1}")).bitwiseXOR(F.col(f"b{i}")).alias(f"x{i + 1}") for i in range(2)])
    return convs.select("c"), keep(head_rows.unionByName(own_rows))


def sequences(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Distinct sequences: depth, x1, x2 of the last node, c (smallest id), n (ids), sha (digest of the sorted ids)."""
    import pyarrow as pa
    last = turns.groupBy("c").agg(F.max(F.struct(*NODE)).alias("e")).select("c", "e.*")
    ends = convs.join(last, "c", "left").na.fill(0)
    names = [*NODE, "c", "n", "said"]

    def rows(kept, shape):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*kept)], names=shape)

    def joined(batches):  # rows in order of node and id: texts of consecutive ids of one node
        now, ids, size = None, [], 0
        for batch in batches:
            out = []
            for d, x, y, c in zip(*(batch.column(k).to_pylist() for k in [*NODE, "c"])):
                if (d, x, y) != now or size > JOINED:
                    if ids:
                        out.append((*now, ids[0], len(ids), ",".join(map(str, ids))))
                    now, ids, size = (d, x, y), [], 0
                ids.append(c)
                size += len(str(c)) + 1
            if out:
                yield rows(out, names)
        if ids:
            yield rows([(*now, ids[0], len(ids), ",".join(map(str, ids)))], names)

    def digested(batches):  # texts in order of node and first id; only the running digest is held
        now, first, n, state = None, 0, 0, None
        for batch in batches:
            out = []
            for d, x, y, c, k, said in zip(*(batch.column(k).to_pylist() for k in names)):
                if (d, x, y) != now:
                    if now:
                        out.append((*now, first, n, state.hexdigest()))
                    now, first, n, state = (d, x, y), c, 0, hashlib.sha256()
                elif n:
                    state.update(b",")
                state.update(said.encode())
                n += k
            if out:
                yield rows(out, [*NODE, "c", "n", "sha"])
        if now:
            yield rows([(*now, first, n, state.hexdigest())], [*NODE, "c", "n", "sha"])

    keys = "depth long, x1 long, x2 long, c long, n long, "
    texts = ends.select(*NODE, "c").repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c").mapInArrow(joined, keys + "said string")
    return keep(texts.repartition(*NODE).sortWithinPartitions(*NODE, "c").mapInArrow(digested, keys + "sha string"))


# ---- double arrays -------------------------------------------------------------------------------------------------

@dataclass
class DoubleArray:
    """BASE and CHECK of a trie: the child of state ``s`` by code ``c`` is ``t = base[s] + c`` if ``check[t] == s``.  State 0 is
    the top; a base may be negative."""

    base: object
    check: object

    @classmethod
    def pack(cls, seqs: list[tuple[int, ...]]) -> "DoubleArray":
        """Pack distinct, sorted, non-empty sequences of codes from 1 on, breadth first."""
        import numpy as np
        base, check, after = [0], [-2], [1]  # check -1: free; after: path to the next free slot

        def grow(size):
            while len(check) < size:
                base.append(0)
                check.append(-1)
                after.append(len(after))

        def free(i):
            grow(i + 1)
            root = i
            while after[root] != root:
                root = after[root]
                grow(root + 1)
            while after[i] != root:
                after[i], i = root, after[i]
            return root

        queue, head = [(0, 0, len(seqs), 0)] if seqs else [], 0
        while head < len(queue):
            state, lo, hi, level = queue[head]
            head += 1
            if len(seqs[lo]) == level:  # the sequence that ends here sorts first
                lo += 1
            spans, at = [], lo
            while at < hi:
                code, end = seqs[at][level], at + 1
                while end < hi and seqs[end][level] == code:
                    end += 1
                spans.append((code, at, end))
                at = end
            if not spans:
                continue
            codes = [c for c, _, _ in spans]
            slot = free(1)
            for _ in range(32):
                grow(slot + codes[-1] - codes[0] + 1)
                if all(check[slot - codes[0] + c] == -1 for c in codes):
                    break
                slot = free(slot + 1)
            else:
                slot = len(check)  # behind everything
                grow(slot + codes[-1] - codes[0] + 1)
            base[state] = slot - codes[0]
            for code, a, b in spans:
                t = base[state] + code
                check[t] = state
                grow(t + 2)
                after[t] = t + 1
                queue.append((t, a, b, level + 1))
        return cls(np.array(base, np.int64), np.array(check, np.int64))

    def walk(self, codes, sizes):
        """States of the sequences that stand in a row in ``codes``, side by side: yields ``(level, sequences, states)``."""
        import numpy as np
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        state, who = np.zeros(len(sizes), np.int64), np.arange(len(sizes))
        for level in range(int(sizes.max()) if len(sizes) else 0):
            who = who[sizes[who] > level]
            t = self.base[state[who]] + codes[starts[who] + level]
            inside = (t > 0) & (t < len(self.check))
            if not inside.all() or (self.check[t] != state[who]).any():
                raise KeyError("a sequence is not in the trie")
            state[who] = t
            yield level, who, t


SHARD_NODES = """conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,
ends_sha256 string, top boolean, u long, u1 long, u2 long"""


def shard_nodes(table):
    """Nodes of a bin of shards.  ``table``: per sequence c, n, sha, the upper node it hangs below (u, u1, u2), s1 and s2 (its
    shard's fingerprint), t and words of its turns from the shard's node on."""
    import numpy as np
    import pyarrow as pa
    cols = {k: table.column(k).to_pylist() for k in ("c", "n", "sha", "u", "u1", "u2", "s1", "s2", "t", "words")}
    tops, dense = {}, {}
    seqs = []
    for s1, s2, t in zip(cols["s1"], cols["s2"], cols["t"]):
        top = tops.setdefault((s1, s2), len(tops) + 1)  # the shard's own node, whatever its depth
        seqs.append((top, *[dense.setdefault(x, len(dense) + 1) for x in t[1:]]))
    order = sorted(range(len(seqs)), key=seqs.__getitem__)
    trie = DoubleArray.pack([seqs[i] for i in order])
    size = len(trie.check)
    weight, ids = np.array(cols["n"], np.int64), np.array(cols["c"], np.int64)
    n_convs, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    words, depth, end, some = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1), np.zeros(size, np.int64)
    sizes = np.array([len(s) for s in seqs], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    said = np.fromiter((w for one in cols["words"] for w in one), np.int64, int(sizes.sum()))
    above, levels = np.array(cols["u"], np.int64), []
    for level, who, t in trie.walk(np.fromiter((c for s in seqs for c in s), np.int64, int(sizes.sum())), sizes):
        np.add.at(n_convs, t, weight[who])
        np.minimum.at(conv, t, ids[who])
        words[t], depth[t], some[t] = said[starts[who] + level], above[who] + level + 1, who
        done = sizes[who] == level + 1
        end[t[done]] = who[done]
        levels.append(np.unique(t))
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), (n_convs - 1) * words
    for t in reversed(levels):
        leaves[t[children[t] == 0]] = 1
        up = trie.check[t]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[t])
        np.add.at(saved, up, saved[t])
    at = np.concatenate(levels)
    top, one = trie.check[at] == 0, some[at]
    parent = conv[trie.check[at]]
    return pa.table({
        "conv_id": conv[at], "depth": depth[at], "parent_conv_id": pa.array(parent, mask=top), "n_convs": n_convs[at], "n_children": children[at],
        "n_leaves": leaves[at], "saved_tokens": saved[at], "ends_sha256": pa.array([cols["sha"][i] if i >= 0 else NOTHING for i in end[at].tolist()], pa.string()),
        "top": top, **{k: np.array(cols[k], np.int64)[one] for k in ("u", "u1", "u2")}})


# ---- the whole trie ------------------------------------------------------------------------------------------------

def subtrees(nodes: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """Sums and minima over each node's subtree.  ``nodes``: id, up (the parent's id, null at the root) and the values.

    Pointer doubling: after round r a node's values cover the nodes less than 2**r below it and ``up`` leads 2**r
    nodes upwards, so the rounds are a logarithm of the depth.
    """
    made = [F.sum(x).alias(x) for x in sums] + [F.min(x).alias(x) for x in least]
    while nodes.where("up is not null").limit(1).count():
        handed = nodes.where("up is not null").select(F.col("up").alias("id"), *sums, *least)
        values = nodes.select("id", *sums, *least).unionByName(handed).groupBy("id").agg(*made)
        further = nodes.select("id", "up").join(nodes.select(F.col("id").alias("up"), F.col("up").alias("_next")), "up", "left").select("id", F.col("_next").alias("up"))
        nodes = keep(further.join(values, "id"))
    return nodes.drop("up")


def trie(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", shard: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(positions(df, key, turn, role, text))
    ends = sequences(convs, turns)
    rows = turns.join(ends.select("c", F.col("depth").alias("size")), "c")
    heavy = (rows.groupBy(*NODE).agg(F.sum(F.col("size") - F.col("depth") + 1).alias("below")).where(F.col("below") > shard)
             .select(*NODE, F.lit(True).alias("upper")))
    rows = keep(rows.join(small(keep(heavy)), NODE, "left"))
    bins = max(1, -(-rows.count() // shard))

    # shards: what lies below a sequence's upper nodes, never more than ``shard`` turns
    is_upper = F.col("upper").isNotNull()
    seqs = rows.groupBy("c").agg(
        F.max(F.when(is_upper, F.struct(*NODE))).alias("up"),
        F.sort_array(F.collect_list(F.when(~is_upper, F.struct("depth", "t", "words", "x1", "x2")))).alias("turns"))
    seqs = seqs.where(F.size("turns") > 0).join(ends.select("c", "n", "sha"), "c")
    zero = F.lit(0).cast("long")
    seqs = seqs.select("c", "n", "sha", *[F.coalesce(F.col("up")[k], zero).alias(a) for k, a in zip(NODE, ("u", "u1", "u2"))],
                       F.col("turns")[0]["x1"].alias("s1"), F.col("turns")[0]["x2"].alias("s2"), F.col("turns.t").alias("t"), F.col("turns.words").alias("words"))
    below = keep(seqs.groupBy(F.pmod(F.xxhash64("s1", "s2"), F.lit(bins)).alias("bin")).applyInArrow(shard_nodes, SHARD_NODES))

    # upper nodes: what shards and ending conversations hand up, merged and carried on
    node = F.struct(*NODE)
    above = [(F.col("depth") - 1).alias("depth"), *[F.col(f"x{i + 1}").bitwiseXOR(m).alias(f"x{i + 1}") for i, m in enumerate(marks(F.col("depth"), F.col("t")))]]
    upper = (rows.where(is_upper).select(node.alias("id"), F.struct(*above).alias("up"), "words").groupBy("id").agg(F.min("up").alias("up"), F.min("words").alias("words")))
    root = df.sparkSession.range(1).select(F.struct(zero.alias("depth"), zero.alias("x1"), zero.alias("x2")).alias("id"))
    upper = keep(root.select("id", F.lit(None).cast("struct<depth:long,x1:long,x2:long>").alias("up"), zero.alias("words")).unionByName(upper))
    handed = (below.where("top").groupBy(F.struct(F.col("u").alias("depth"), F.col("u1").alias("x1"), F.col("u2").alias("x2")).alias("id"))
              .agg(F.sum("n_convs").alias("n1"), F.min("conv_id").alias("c1"), F.count("*").alias("k1"), F.sum("n_leaves").alias("leaves1"), F.sum("saved_tokens").alias("saved1")))
    ending = ends.select(node.alias("id"), F.col("n").alias("n2"), F.col("c").alias("c2"), "sha")
    kids = upper.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("k2"))
    upper = keep(upper.join(handed, "id", "left").join(ending, "id", "left").join(kids, "id", "left")
                 .na.fill(0, ["n1", "n2", "k1", "k2", "leaves1", "saved1"]).withColumn("n_children", F.col("k1") + F.col("k2")))
    count = subtrees(upper.select("id", "up", (F.col("n1") + F.col("n2")).alias("n_convs"), F.least("c1", "c2").alias("conv_id")), ["n_convs"], ["conv_id"])
    upper = keep(upper.join(count, "id").where("conv_id is not null"))
    own = upper.select("id", "up", (F.col("saved1") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
                       (F.col("leaves1") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"))
    upper = upper.join(subtrees(own, ["saved_tokens", "n_leaves"], []), "id")
    parent = keep(upper.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id")))
    shape = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    over = (upper.join(parent, "up", "left").withColumn("depth", F.col("id.depth")).withColumn("ends_sha256", F.coalesce("sha", F.lit(NOTHING))).select(*shape))
    tops = (below.where("top").drop("parent_conv_id").withColumn("up", F.struct(F.col("u").alias("depth"), F.col("u1").alias("x1"), F.col("u2").alias("x2")))
            .join(parent, "up").select(*shape))
    return over.unionByName(tops).unionByName(below.where("not top").select(*shape))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return trie(read(spark, sf_dir, "conversations"))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}

#: Paths are the joined md5s of their turns, so a subtree is what starts with a path.
ORACLE = {"op13_prefix_trie": r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) - 1 AS k FROM t),
convs AS (
  SELECT c, c - c % 20 AS b, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(c AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))),
      lambda a, byte: list_reduce(list_prepend(xor(a, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM k)),
heads AS (SELECT v.c, h.k AS place, h.t, h.w FROM convs v JOIN k h ON h.c = v.b AND h.k < v.h),
turns AS (SELECT * FROM heads UNION ALL SELECT v.c, k.k + 10, k.t, k.w FROM convs v JOIN k ON k.c = v.c AND k.k >= v.h),
paths AS (
  SELECT c, row_number() OVER o AS depth, string_agg('/' || t, '') OVER o AS p, w FROM turns WINDOW o AS (PARTITION BY c ORDER BY place)
  UNION ALL SELECT c, 0, '', 0 FROM convs),
ends AS (SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM (SELECT c, max_by(p, depth) AS p FROM paths GROUP BY c) GROUP BY p),
nodes AS (SELECT p, depth, left(p, greatest(length(p) - 33, 0)) AS up, min(c) AS conv_id, count(*) AS n_convs, min(w) AS w FROM paths GROUP BY p, depth),
kids AS (SELECT up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
below AS (
  SELECT a.p, sum((b.n_convs - 1) * b.w) AS saved, count(*) FILTER (WHERE q.n IS NULL) AS leaves
  FROM nodes a JOIN nodes b ON starts_with(b.p, a.p) LEFT JOIN kids q ON q.up = b.p GROUP BY a.p)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(q.n, 0) AS n_children, l.leaves AS n_leaves, CAST(l.saved AS BIGINT) AS saved_tokens,
  coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.up AND u.depth = n.depth - 1 LEFT JOIN kids q ON q.up = n.p JOIN below l ON l.p = n.p LEFT JOIN ends e ON e.p = n.p
"""}
