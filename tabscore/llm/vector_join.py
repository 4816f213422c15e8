"""Embedding near-duplicates: exact metric range join over pivots.

Identical vectors are one representative.  The angle between vectors is a metric, so the triangle inequality prunes
whole cells: every representative has a home cell (its nearest pivot), and is also sent as a guest to a cell ``q``
with a smaller number, unless ``angle(x, q) - radius(q) > t`` or ``angle(x, q) - angle(x, home) > 2 t`` (``t``: the
threshold's angle), for then no vector of that cell can be near.  A pair is met in one cell: that of the smaller
home.  Cells are cut into blocks of bounded size, so a dense cell is many tasks, and every block joins
independently.  A block returns link counts per vector and a spanning forest of its links, never all pairs.  Tasks hand
vectors over, and look at a block's pairs, in pieces of bounded bytes, so their memory, but for the pivots, grows neither
with the number of vectors nor with their length.

Pivots: the ``ceil(n ** (1/3))`` representatives with the smallest hash (no sampling of rows: pivots only steer the
partitioning, every vector is compared).

Defined results: a vector that is null, zero, empty or holds a null or non-finite component links with nothing; vectors of
different lengths never link; repeated rows are linked rows; rows with a null id are dropped from links but not from
the result (their component is null).  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tabscore.llm.chunks import giving_back, slices
from tabscore.llm.common import components, keep, read

#: Representatives that meet in one block, per side, and bytes of their unit vectors.
BLOCK, BLOCK_BYTES = 16_384, 64_000_000
#: Bytes that a task hands over at once, about; pairs of a block looked at together, and numbers of the vectors of those decided together.
SENT_BYTES, PAIRS, NUMBERS = 4_000_000, 2_000_000, 4_000_000


def unit(rows):
    """Rows as unit vectors in double precision; rows are scaled by their largest component first, so no square overflows or vanishes."""
    import numpy as np
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


def angles(x, pivots):
    import numpy as np
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def block_links(ids_a, a, weight_a, ids_b, b, weight_b, cosine: float):
    """Link counts and a spanning forest of the links between two blocks (``ids_b`` None: within one).

    A product in single precision finds candidates with room for its rounding; they are decided in double precision.
    """
    import numpy as np
    own = ids_b is None
    if own:
        ids_b, b, weight_b = ids_a, a, weight_a
    n = len(ids_a)
    count_a, count_b = np.zeros(n, np.int64), np.zeros(len(ids_b), np.int64)
    label = np.arange(n) if own else np.arange(n + len(ids_b))
    shift = 0 if own else n
    edges = []
    a32, b32 = a.astype(np.float32), b.astype(np.float32)
    step, some = max(1, PAIRS // max(1, len(ids_b))), max(1, NUMBERS // a.shape[1])
    for start in range(0, n, step):
        first = start if own else 0  # within a block, pairs with later vectors only
        near_i, near_j = np.divmod(np.flatnonzero(a32[start:start + step] @ b32[first:].T >= cosine - 1e-4), len(b32) - first)
        near_i, near_j = near_i + start, near_j + first
        if own:
            upper = near_j > near_i
            near_i, near_j = near_i[upper], near_j[upper]
        keep_i, keep_j = [], []
        for k in range(0, len(near_i), some):  # bounds the rows decided at once
            i, j = near_i[k:k + some], near_j[k:k + some]
            hit = np.einsum("ij,ij->i", a[i], b[j]) >= cosine
            keep_i.append(i[hit])
            keep_j.append(j[hit])
        if not keep_i:
            continue
        i, j = np.concatenate(keep_i), np.concatenate(keep_j)
        np.add.at(count_a, i, weight_b[j])
        np.add.at(count_b, j, weight_a[i])
        cuts = np.flatnonzero(np.diff(i)) + 1
        for row, others in zip(i[np.concatenate([[0], cuts])] if len(i) else [], np.split(j, cuts)):
            seen = label[others + shift]
            fresh = seen != label[row]
            if fresh.any():
                for other, at in zip(*np.unique(seen[fresh], return_index=True)):
                    edges.append((ids_a[row], ids_b[others[fresh][at]]))
                    label[label == other] = label[row]
    if own:
        count_a = count_a + count_b
        pairs = zip(ids_a, count_a)
    else:
        pairs = [*zip(ids_a, count_a), *zip(ids_b, count_b)]
    return [(int(i), int(c)) for i, c in pairs if c], [(int(u), int(v)) for u, v in edges]


def near_vectors(df: DataFrame, cosine: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per input row: key, n_links, component_id, kept."""
    angle = math.acos(cosine) + 1e-6
    src = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    fit = F.col("id").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)
    src = src.withColumn("fit", F.coalesce(fit, F.lit(False)))
    good = src.where("fit")
    reps = keep(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
                .withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("v")))
    links, single = [], isinstance(df.schema[vector].dataType.elementType, FloatType)
    for (dim,) in reps.select("dim").distinct().collect():
        links.append(_links(reps.where(F.col("dim") == dim), cosine, angle, dim, single))
    none = df.sparkSession.createDataFrame([], "u long, v long, n long")
    found = none
    for x in links:
        found = found.unionByName(x)
    found = keep(found)
    counts = found.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    comp = components(found.where("v is not null").select("u", "v"))
    known = (reps.join(counts.withColumnRenamed("u", "rep"), "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
             .select("h", F.col("v").alias("w"), "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.coalesce("component_id", "rep").alias("root")))
    # Rows find their representative by the vector itself; a hot vector's rows are a skewed side that AQE splits.
    mine = good.select("id", F.col("v").alias("w"), F.xxhash64("v").alias("h")).join(known, ["h", "w"])
    out = mine.select("id", F.col("links"), "root").unionByName(
        src.where("not fit").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("root")))
    return out.select(F.col("id").alias(key), F.col("links").cast("long").alias("n_links"),
                      F.col("root").cast("long").alias("component_id"), (F.col("id") == F.col("root")).alias("kept"))


def rows_of(column):
    """Vectors of an Arrow list column, all of one length and without nulls, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _links(reps: DataFrame, cosine: float, angle: float, dim: int, single: bool) -> DataFrame:
    """``(u, null, n)``: n links of u; ``(u, v, null)``: an edge of the spanning forest.  ``single``: all components are single-precision
    numbers and are sent as such."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    n = reps.count()
    k = max(1, math.ceil(n ** (1 / 3)))
    pivots = unit([r.v for r in reps.orderBy("h", "rep").select("v").limit(k).collect()])  # bounded: the cube root of n
    side = max(1, min(BLOCK, BLOCK_BYTES // (8 * dim), math.ceil(n / 4)))
    number, together, most = "<f4" if single else "<f8", max(1, SENT_BYTES // (8 * (len(pivots) + dim))), SENT_BYTES
    cell = np.arange(len(pivots))

    def near(batches):
        """``(batch, x, angles, home)`` of a few rows at a time, whatever their length and the number of pivots."""
        for whole in batches:
            for start in range(0, whole.num_rows, together):
                batch = whole.slice(start, together)
                x = rows_of(batch.column("v"))
                a = angles(unit(x), pivots)
                yield batch, x, a, a.argmin(1)

    def home(batches):
        for _, _, a, at in near(batches):
            yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int32), "far": a[np.arange(len(at)), at]})

    cells = {r.cell: (r.n, r.far) for r in reps.select("v").mapInArrow(home, "cell int, far double").groupBy("cell")
             .agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}  # a row per pivot
    radius = np.array([cells.get(c, (0, -9.0))[1] for c in range(len(pivots))])
    homes = np.array([max(1, math.ceil(cells.get(c, (0, 0))[0] / side)) for c in range(len(pivots))])

    def visits(a, at):
        """Which rows are guests of which cells."""
        return (a <= radius + angle) & (a - a[np.arange(len(at)), at][:, None] <= 2 * angle) & (cell < at[:, None])

    def count_guests(batches):
        for _, _, a, at in near(batches):
            yield pa.RecordBatch.from_pydict({"cell": cell.astype(np.int32), "n": visits(a, at).sum(0)})

    seen = {r.cell: r.n for r in reps.select("v").mapInArrow(count_guests, "cell int, n long").groupBy("cell")
            .agg(F.sum("n").alias("n")).collect()}
    guests = np.array([math.ceil((seen.get(c) or 0) / side) for c in range(len(pivots))])

    def send(batches):
        """Rows per block they take part in.  Of a cell with g home chunks, blocks are (i, j) with i <= j for homes, and
        (i, -1 - c) for guests' chunk c; rows fall into chunks by their hash.  As many rows are looked at as fill one batch of
        bounded size: a row goes to more blocks the more rows there are."""
        def times(rows, how_often):
            """Each row as often as it says, and the number of its repetition."""
            ends = np.cumsum(how_often)
            return np.repeat(rows, how_often), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - how_often, how_often)

        for batch, x, a, at in near(batches):
            raw, h = np.ascontiguousarray(x, number), batch.column("h").to_numpy()
            rep, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
            own, visit = h % homes[at], visits(a, at)
            sizes = (homes[at] + guests[at] + visit @ homes) * (raw.shape[1] * raw.itemsize + 64)
            for start, end in slices(sizes.tolist(), most):
                some = np.arange(start, end)
                r1, o1 = times(some, homes[at[some]])
                r2, o2 = times(some, guests[at[some]])
                g, q = np.nonzero(visit[start:end])
                r3, o3 = times(np.arange(len(g)), homes[q])
                r3, q = g[r3] + start, q[r3]
                r = np.concatenate([r1, r2, r3])
                width, data = raw.shape[1] * raw.itemsize, raw[r]
                yield pa.RecordBatch.from_pydict({
                    "cell": np.concatenate([at[r1], at[r2], q]).astype(np.int32),
                    "i": np.concatenate([np.minimum(own[r1], o1), own[r2], o3]).astype(np.int32),
                    "j": np.concatenate([np.maximum(own[r1], o1), -1 - o2, -1 - (h[r3] >> 20) % guests[q]]).astype(np.int32),
                    "guest": np.concatenate([own[r1] > o1, np.zeros(len(r2), bool), np.ones(len(r3), bool)]), "rep": rep[r], "copies": copies[r],
                    "x": pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(np.arange(len(r) + 1, dtype=np.int32) * width), pa.py_buffer(data)])})

    def join(part):
        x = unit(np.frombuffer(b"".join(part["x"]), number).reshape(len(part), -1))
        ids, copies, guest = part["rep"].to_numpy(), part["copies"].to_numpy(), part["guest"].to_numpy(bool)
        own = part["j"].iloc[0] == part["i"].iloc[0]
        if own:
            counts, edges = block_links(ids, x, copies, None, None, None, cosine)
        else:
            m = ~guest
            counts, edges = block_links(ids[m], x[m], copies[m], ids[guest], x[guest], copies[guest], cosine)
        return pd.DataFrame({"u": [u for u, _ in counts] + [u for u, _ in edges], "v": [None] * len(counts) + [v for _, v in edges],
                             "n": [c for _, c in counts] + [None] * len(edges)}).astype({"u": "int64", "v": "Int64", "n": "Int64"})

    blocks = reps.select("v", "rep", "copies", "h").mapInArrow(
        giving_back(send), "cell int, i int, j int, guest boolean, rep long, copies long, x binary")
    return blocks.groupBy("cell", "i", "j").applyInPandas(join, "u long, v long, n long")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``: vec_id, n_links, component_id, kept."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES = {"op1_near_vectors": op1_near_vectors}
