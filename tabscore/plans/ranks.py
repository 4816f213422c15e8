"""Distributed rank and running-sum plans.

Spark runs a window without ``partitionBy`` in one task, and a window
partitioned by a class puts a whole class in one task.  A class can hold a
third (or more) of all rows, so the operators here never do either.  They cut
the seeded order into many small cells first:

* every row gets ``_h`` (md5 of seed and key) and a bucket ``_b`` from the
  first 32 bits of ``_h``, so ordering by ``(_b, _h)`` *is* the md5 order and
  buckets are uniform by construction;
* a partial ``groupBy(class, bucket).count()`` gives per-cell sizes (at most
  ``classes × buckets`` rows, independent of the row count); prefix offsets are
  a window over that small table;
* a row's rank is its cell's offset plus its ``row_number`` inside the cell.

``smallest_by_hash`` picks the n smallest hashes without ranking everything:
one aggregate counts rows under 33 dyadic cuts of the md5 fraction, and the
smallest cut that still holds n rows (between n and 2n of them) bounds the
rows that are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscore.functions.hashing import order_hash, unit_fraction
from tabscore.functions.text import col

DEFAULT_BUCKETS = 1 << 18
# Rows of a per-class table up to which it is sent to all executors (counted first).
BROADCAST_CLASSES = 1_000_000


def with_hash(df: DataFrame, keys: Sequence[str], seed: int = 42,
              buckets: int | None = None) -> DataFrame:
    """Add ``_h`` (order hash), ``_f`` (fraction in [0,1)) and ``_b`` (bucket)."""
    buckets = buckets or DEFAULT_BUCKETS
    return (df.withColumn("_h", order_hash(keys, seed))
              .withColumn("_f", unit_fraction(keys, seed))
              .withColumn("_b", F.floor(F.col("_f") * F.lit(buckets)).cast("int")))


def _tie_break(keys: Sequence[str]) -> list[Column]:
    return [F.col("_h")] + [col(k) for k in keys]


def rank_in_class(df: DataFrame, class_cols: Sequence[str], keys: Sequence[str],
                  seed: int = 42, buckets: int | None = None,
                  rank_col: str = "rank") -> DataFrame:
    """Exact 1-based rank of every row inside its class by the seeded md5
    order.  Shuffles rows by (class, bucket); no cell is larger than about
    ``class size / buckets``."""
    # The class as one struct: never NULL itself, and NULL fields compare equal,
    # so a NULL class is ranked like any other and the join and the window
    # below share one hash partitioning of the rows.
    h = with_hash(df, keys, seed, buckets).withColumn("_k", _class_key(class_cols))
    cells = h.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    prefix = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("_k", "_b", F.coalesce(F.sum("_n").over(prefix), F.lit(0)).alias("_off"))
    in_cell = Window.partitionBy("_k", "_b").orderBy(*_tie_break(keys))
    return (h.join(offsets, ["_k", "_b"], "inner")
             .withColumn(rank_col, F.col("_off") + F.row_number().over(in_cell))
             .drop("_k", "_h", "_f", "_b", "_off"))


def _class_key(class_cols: Sequence[str]) -> Column:
    return F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(class_cols)], F.lit(0).alias("_"))


def _class_match(class_cols: Sequence[str], values: tuple) -> Column:
    cond = F.lit(True)
    for c, v in zip(class_cols, values):
        cond = cond & col(c).eqNullSafe(F.lit(v))
    return cond


def _dyadic_cut(k: int) -> str:
    """Hex prefix bound for ``fraction < 2^-k`` (k = 0 keeps everything)."""
    return "g" if k == 0 else f"{1 << (32 - k):08x}"


def smallest_by_hash(df: DataFrame, quota: Mapping[tuple, int] | int, keys: Sequence[str],
                     seed: int = 42, class_cols: Sequence[str] = ()) -> DataFrame:
    """Rows with the ``quota`` smallest order hashes (per class when
    ``class_cols`` is given): ``ORDER BY md5 LIMIT n`` in two passes.

    Pass 1 is one aggregate: per class, the number of rows by the largest k of
    0..32 for which their md5 fraction is below 2^-k.  The largest k whose count still reaches the
    quota gives a cut holding between n and 2n rows (or the whole class).
    Pass 2 keeps the rows under each class's cut and ranks only those, with
    ``rank_in_class`` over (class, bucket) cells, so no quota lands in one
    task.  ``quota`` names its classes, so the conditions built from it are
    as many as the caller wrote."""
    if isinstance(quota, int):
        quota = {(): quota}
    quota = {c: n for c, n in quota.items() if n > 0}
    h = df.withColumn("_h", order_hash(keys, seed))
    if not quota:
        return h.where(F.lit(False)).drop("_h")
    pre = F.substring(F.col("_h"), 1, 8)
    # A row's class by number, and the deepest cut it is under: half of the rows are above the first, so few texts are compared.
    number, depth = F.lit(None).cast("int"), F.when(pre >= F.lit(_dyadic_cut(1)), F.lit(0))
    for ci, cls in enumerate(quota):
        number = F.when(_class_match(class_cols, cls), F.lit(ci)).otherwise(number)
    for k in range(1, 32):
        depth = depth.when(pre >= F.lit(_dyadic_cut(k + 1)), F.lit(k))
    found = h.groupBy(number.alias("c"), depth.otherwise(F.lit(32)).alias("z")).agg(F.count(F.lit(1)).alias("n")).collect()  # classes x 33 rows
    counts = {f"c{ci}_{k}": sum(r["n"] for r in found if r["c"] == ci and r["z"] >= k) for ci in range(len(quota)) for k in range(33)}
    cond = F.lit(False)
    for ci, (cls, n) in enumerate(quota.items()):
        k = max(k for k in range(33) if counts[f"c{ci}_{k}"] >= min(n, counts[f"c{ci}_0"]))
        cond = cond | (_class_match(class_cols, cls) & (pre < F.lit(_dyadic_cut(k))))
    cand = h.where(cond)
    limit = F.lit(0)
    for cls, n in quota.items():
        limit = F.when(_class_match(class_cols, cls), F.lit(n)).otherwise(limit)
    ranked = rank_in_class(cand.drop("_h"), class_cols, keys, seed, rank_col="_rn")
    return ranked.where(F.col("_rn") <= limit).drop("_rn")


def leading_zeros32(h: Column) -> Column:
    """Leading zero bits (0..32) of the 32-bit md5 prefix of hex ``h``: a row
    is under the dyadic cut 2^-k exactly when this is at least k.  The bit
    length comes from ``log2`` and is then corrected against powers of two
    (exact doubles, as is every 32-bit value), so the result is exact."""
    v = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    bl = (F.floor(F.log2(v)) + 1).cast("int")
    two = F.lit(2.0)
    bl = (F.when(F.pow(two, bl - 1) > v, bl - 1)
           .when(F.pow(two, bl) <= v, bl + 1)
           .otherwise(bl))
    return F.when(v == 0, F.lit(32)).otherwise(F.lit(32) - bl)


def smallest_per_class(df: DataFrame, class_cols: Sequence[str], n: int, keys: Sequence[str],
                       seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest order hashes in every class (classes
    found in the data, NULL being one), in two passes.

    Pass 1 counts rows per (class, leading zero bits): at most classes × 33
    rows, combined map-side.  Per class, the deepest dyadic cut that still
    holds n rows (or the whole class) is taken from that table.  Pass 2
    keeps the rows under their class's cut (about 2n per class) and ranks
    only those, over (class, bucket) cells.  The cut table has one row per
    class; it is counted, and broadcast when small, so that only candidates
    are shuffled and never the table on its class."""
    if n <= 0:
        return df.where(F.lit(False))
    h = (df.withColumn("_h", order_hash(keys, seed)).withColumn("_z", leading_zeros32(F.col("_h")))
           .withColumn("_k", _class_key(class_cols)))
    counts = h.groupBy("_k", "_z").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    deeper = Window.partitionBy("_k").orderBy(F.desc("_z")).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy("_k")
    cuts = (counts.withColumn("_ge", F.sum("_n").over(deeper)).withColumn("_tot", F.sum("_n").over(total))
                  .where(F.col("_ge") >= F.least(F.lit(n), F.col("_tot")))
                  .groupBy("_k").agg(F.max("_z").alias("_cut")))
    cand = h.join(_sent(cuts), "_k", "inner").where(F.col("_z") >= F.col("_cut")).drop("_k", "_cut", "_z", "_h")
    ranked = rank_in_class(cand, class_cols, keys, seed, rank_col="_rn")
    return ranked.where(F.col("_rn") <= n).drop("_rn")


def _sent(per_class: DataFrame) -> DataFrame:
    """A per-class table, marked for broadcast if its counted rows are few
    enough; beyond that AQE plans an ordinary join (and splits hot classes)."""
    return F.broadcast(per_class) if per_class.count() <= BROADCAST_CLASSES else per_class


def split_by_quota(df: DataFrame, class_cols: Sequence[str], keys: Sequence[str],
                   quota: Callable[[DataFrame], DataFrame], seed: int = 42,
                   buckets: int | None = None, flag_col: str = "is_first") -> DataFrame:
    """Flag the first rows of each class in md5 order, as many as its quota,
    without ranking all rows: whole buckets below the boundary bucket are in,
    whole buckets above are out, and only the boundary bucket's rows are
    ranked, so repeated keys cannot make a class exceed its quota (ties go by
    a hash of the whole row).

    ``quota`` maps the table of class totals ``(_k, n)`` to ``(_k, _q)``.  Totals come from the
    (class, bucket) cell table, which is checkpointed (at most classes × buckets rows); the data is read three
    times in all: cells, rows of boundary buckets, other rows.  A class may be NULL."""
    h = with_hash(df, keys, seed, buckets).withColumn("_k", _class_key(class_cols))
    cells = h.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    quotas = quota(cells.groupBy("_k").agg(F.sum("_n").alias("n"))).select("_k", "_q")
    run = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = cells.withColumn("_cum", F.sum("_n").over(run)).join(quotas, "_k")
    # Boundary bucket per class: the first whose running count reaches the
    # quota; ``_need`` of its rows are in the first part.  A quota above the
    # class's size has none: then all rows are first.
    bound = (cum.groupBy("_k").agg(
        F.min(F.when(F.col("_cum") >= F.col("_q"), F.struct("_b", (F.col("_q") - (F.col("_cum") - F.col("_n"))).alias("need")))).alias("s"))
        .select("_k", F.col("s._b").alias("_bb"), F.col("s.need").alias("_need"))).checkpoint(eager=True)
    marked = h.join(_sent(bound), "_k", "left")
    at_bound = F.coalesce(F.col("_b") == F.col("_bb"), F.lit(False))
    rest = marked.where(~at_bound).withColumn(flag_col, F.col("_bb").isNull() | (F.col("_b") < F.col("_bb")))
    w = Window.partitionBy("_k").orderBy(*_tie_break(keys), F.xxhash64(*[col(c) for c in df.columns]))
    edge = (marked.where(at_bound).withColumn("_rn", F.row_number().over(w))
                  .withColumn(flag_col, F.col("_rn") <= F.col("_need")).drop("_rn"))
    return rest.unionByName(edge).drop("_k", "_h", "_f", "_b", "_bb", "_need")


def running_sums_desc(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                      buckets: int = 1024) -> DataFrame:
    """Running sums of ``sum_cols`` over ``order_col`` descending (one row per
    distinct order value expected).  Rows are cut into monotone buckets at
    approximate quantiles of the values themselves, so however the values are
    squeezed together a bucket holds about ``rows / buckets`` of them.  Prefix
    offsets come from the bucket table (at most ``buckets + 1`` rows, so
    broadcasting it is bounded); inside a bucket a window adds the rest."""
    from pyspark.ml.feature import Bucketizer
    # A NULL value ranks below every other.
    o = F.coalesce(col(order_col).cast("double"), F.lit(-math.inf))
    probs = [i / buckets for i in range(1, buckets)]
    q = df.agg(F.percentile_approx(o, probs, 10 * buckets).alias("q")).first()["q"]
    cuts = sorted({float(x) for x in (q or []) if math.isfinite(x)})
    b = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_o", outputCol="_bk", handleInvalid="keep") \
        .transform(df.withColumn("_o", o))
    totals = b.groupBy("_bk").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sum_cols)])
    prefix = Window.orderBy(F.desc("_bk")).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("_bk", *[F.coalesce(F.sum(f"_t{i}").over(prefix), F.lit(0)).alias(f"_o{i}")
                                  for i in range(len(sum_cols))])
    within = Window.partitionBy("_bk").orderBy(F.desc("_o")).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offs), "_bk", "inner")
    for i, c in enumerate(sum_cols):
        out = out.withColumn(f"cum_{c}", F.col(f"_o{i}") + F.sum(c).over(within))
    return out.drop("_o", "_bk", *[f"_o{i}" for i in range(len(sum_cols))])



def with_place(ordered: DataFrame, name: str = "place") -> DataFrame:
    """Number the rows of a sorted frame from 1 in the order they come: the
    rows are written to the checkpoint folder, and a row's place is its number
    within its partition plus the rows of the partitions before (a table of
    one row per partition)."""
    kept = ordered.checkpoint(eager=True).select(
        "*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_i"))
    sizes = kept.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return kept.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_off") + F.col("_i") + 1).drop("_p", "_i", "_off")
