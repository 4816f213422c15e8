"""Class histograms and mixed-type association.

* ``class_histogram``: unpivot the numeric columns to ``(column, class, x)``,
  one partial ``min/max`` per column (a table with one row per column), an
  equi-join back on the column name, equal-width bins over the joint range
  and a partial ``count`` per ``(column, class, bin)``.  All rows are used.
* ``contingency``: one scan; numeric columns become equal-width bins in the
  JVM, and each task codes the values of its rows as small integers and
  co-counts all column pairs in numpy, a slab of rows at a time.  Only cells
  leave a task; Spark adds them up per ``(a, b, va, vb)``.
* χ² and Cramér's V are SQL aggregates over those cells (written once), with
  margins by aggregates and joins.
* φ_K inverts a bivariate-normal χ² for all pairs at once: corner rows from
  joined margins, quadrature as an expression, map-side sums over cells, and a
  section search that looks at ``PHIK_POINTS`` correlations per pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscore.functions.text import col
from tabscore.session import ensure_checkpoint_dir


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    packed = df.select(*[col(k) for k in keep], *[col(c).cast("double").alias(c) for c in cols])
    # NaN counts as missing: one NaN in a range would spoil every bin.
    return (packed.unpivot(list(keep), list(cols), "column", "x").where(F.col("x").isNotNull() & ~F.isnan("x")))


def class_histogram(df: DataFrame, cols: Sequence[str], target: str, bins: int = 100) -> DataFrame:
    """Per numeric column and class, ``bins`` equal-width bins over the
    joint range; ``density = n / (n_class * width)`` per class (each class
    normalised on its own).  A constant column has one bin of width 1."""
    long = _long(df.where(col(target).isNotNull()), cols, [target]).withColumnRenamed(target, "cls")
    rng = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    span = F.col("hi") - F.col("lo")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / span * bins), F.lit(bins - 1))).cast("int")
    # The range table has one row per column: a bounded broadcast.
    counts = (long.join(F.broadcast(rng), "column").withColumn("bin", b)
              .groupBy("column", "cls", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n")))
    width = F.when(span == 0, F.lit(1.0)).otherwise(span / bins)
    per_class = Window.partitionBy("column", "cls")
    return (counts.withColumn("n_class", F.sum("n").over(per_class))
            .select("column", F.col("cls").alias("class"), "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n",
                    (F.col("n") / (F.col("n_class") * width)).alias("density")))


def _finite(name: str):
    """A numeric column as double, NaN counting as missing."""
    x = col(name).cast("double")
    return F.when(~F.isnan(x), x)


def binned(df: DataFrame, num: Sequence[str], bins: int = 10) -> list:
    """Each numeric column's equal-width bin (from 0) over the column's range, fit with one global aggregate; missing: null."""
    if not num:
        return []
    aggs = []
    for i, c in enumerate(num):
        x = _finite(c)
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    r, out = df.agg(*aggs).first(), []
    for i, c in enumerate(num):
        lo, hi = r[f"lo{i}"], r[f"hi{i}"]
        x = _finite(c)
        if lo is None or hi == lo:
            e = F.when(x.isNotNull(), F.lit(0))
        else:
            e = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
        out.append(e.cast("int"))
    return out


#: Rows that a task co-counts at a time, at most.
SLAB_ROWS = 200_000


def _cells(codes: list[np.ndarray], values: list[list], pairs: list[tuple[int, int]]):
    """Cells of a slab: per pair its numbers, and the codes and counts of its non-empty cells (code 0: missing)."""
    for i, j in pairs:
        wide = len(values[j])
        key = codes[i] * wide + codes[j]
        if len(values[i]) * wide <= 4 * len(key) + 1000:
            n = np.bincount(key, minlength=len(values[i]) * wide)
            key = np.flatnonzero(n)
            n = n[key]
        else:
            key, n = np.unique(key, return_counts=True)
        ci, cj = key // wide, key % wide
        both = (ci > 0) & (cj > 0)
        yield i, j, ci[both], cj[both], n[both]


def contingency(df: DataFrame, num: Sequence[str], cat: Sequence[str], bins: int = 10,
                pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """``(a, b, va, vb, n)`` for every column pair; rows missing either
    value are dropped per pair."""
    import pyarrow as pa
    names = list(num) + list(cat)
    pairs = list(pairs) if pairs is not None else [(names[i], names[j]) for i in range(len(names))
                                                   for j in range(i + 1, len(names))]
    numbered = [(names.index(a), names.index(b)) for a, b in pairs]
    # A row's bins travel as few longs (0: missing), whole numbers and booleans as they are: what a task takes over is the cost here.
    bits = (bins + 1).bit_length()
    per = 63 // bits
    bin_of = [F.coalesce(e + 1, F.lit(0)).cast("bigint") for e in binned(df, num, bins)]
    packed = [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(e, bits * k) for k, e in enumerate(bin_of[at:at + per])]) for at in range(0, len(num), per)]
    plain = [col(c) if df.schema[c].dataType.typeName() in ("boolean", "byte", "short", "integer", "long") else col(c).cast("string") for c in cat]
    c, longs = df.select(*[e.alias(f"c{k}") for k, e in enumerate([*packed, *plain])]), len(packed)
    bin_values = [None, *map(str, range(bins))]
    written = {True: "true", False: "false"}

    def count(batches):
        def begun():
            return [{None: 0} for _ in cat], [[] for _ in names], 0

        known, held, rows = begun()

        def flush():
            values = [bin_values] * len(num) + [[None, *(written[v] if isinstance(v, bool) else str(v) for v in list(k)[1:])] for k in known]
            codes = [np.concatenate(h) for h in held]
            for i, j, ci, cj, n in _cells(codes, values, numbered):
                if len(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), k, np.int32)) for k in (i, j)]
                        + [pa.array(values[k], pa.string()).take(pa.array(x)) for k, x in ((i, ci), (j, cj))] + [pa.array(n, pa.int64())],
                        names=["i", "j", "va", "vb", "n"])

        for batch in batches:
            for k in range(len(num)):
                held[k].append((batch.column(k // per).to_numpy() >> (bits * (k % per))) & ((1 << bits) - 1))
            for k, own in enumerate(known):
                d = batch.column(longs + k).dictionary_encode()
                to = np.array([own.setdefault(v, len(own)) for v in d.dictionary.to_pylist()] + [0], np.int64)
                held[len(num) + k].append(to[d.indices.fill_null(len(to) - 1).to_numpy(zero_copy_only=False)])
            rows += batch.num_rows
            if rows >= SLAB_ROWS:
                yield from flush()
                known, held, rows = begun()
        if rows:
            yield from flush()

    labels = F.array(*[F.lit(n) for n in names])
    return (c.mapInArrow(count, "i int, j int, va string, vb string, n long")
            .groupBy("i", "j", "va", "vb").agg(F.sum("n").alias("n"))
            .select(F.get(labels, F.col("i")).alias("a"), F.get(labels, F.col("j")).alias("b"), "va", "vb", "n"))


def stored_cells(ct: DataFrame) -> DataFrame:
    """Contingency rows written once to the shared checkpoint folder: the margins read them several times."""
    ensure_checkpoint_dir(ct.sparkSession)
    return ct.checkpoint(eager=True)


def _margins(ct: DataFrame) -> DataFrame:
    """Contingency rows with the margins ``ra``, ``rb`` and the pair's total:
    aggregates that combine map-side and joins, no window over a whole pair."""
    ra = ct.groupBy("a", "b", "va").agg(F.sum("n").alias("ra"))
    rb = ct.groupBy("a", "b", "vb").agg(F.sum("n").alias("rb"))
    tot = ct.groupBy("a", "b").agg(F.sum("n").alias("_tot"))
    return ct.join(ra, ["a", "b", "va"]).join(rb, ["a", "b", "vb"]).join(tot, ["a", "b"])


def chi2_table(ct: DataFrame) -> DataFrame:
    """χ², degrees of freedom and Cramér's V per pair from contingency rows.
    Uses χ² = Σ O²/E − n summed over the non-empty cells only: an empty
    cell contributes E to Σ(O−E)²/E and E to Σ E, so it cancels."""
    t = _margins(ct)
    e = F.col("ra") * F.col("rb") / F.col("_tot")
    agg = t.groupBy("a", "b").agg(
        F.first("_tot").alias("n"), (F.sum(F.col("n") * F.col("n") / e) - F.first("_tot")).alias("chi2"),
        F.count_distinct("va").alias("r"), F.count_distinct("vb").alias("c"))
    k = F.least(F.col("r"), F.col("c")) - 1
    return agg.select("a", "b", "n", "r", "c", "chi2",
                      ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
                      F.when(k <= 0, F.lit(0.0)).otherwise(F.sqrt(F.col("chi2") / F.col("n") / k)).alias("cramers_v"))


# -- phi_K ---------------------------------------------------------------------

_GL_X, _GL_W = np.polynomial.legendre.leggauss(24)


def _ncdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.vectorize(math.erf)(np.asarray(x, dtype=float) / math.sqrt(2.0)))


def _nppf(p: float) -> float:
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    lo, hi = -12.0, 12.0
    for _ in range(80):
        mid = (lo + hi) / 2
        if 0.5 * (1 + math.erf(mid / math.sqrt(2))) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def _bvn_cdf(h: float, k: float, rho: float) -> float:
    """P(X ≤ h, Y ≤ k) for a standard bivariate normal with correlation rho,
    by Gauss-Legendre on θ in Φ2 = Φ(h)Φ(k) + 1/2π ∫_0^asin ρ exp(...) dθ."""
    if h == -math.inf or k == -math.inf:
        return 0.0
    if h == math.inf:
        return float(_ncdf(k))
    if k == math.inf:
        return float(_ncdf(h))
    base = float(_ncdf(h) * _ncdf(k))
    if rho == 0:
        return base
    top = math.asin(rho)
    th = (_GL_X + 1) * top / 2
    w = _GL_W * top / 2
    s, c2 = np.sin(th), np.cos(th) ** 2
    f = np.exp(-(h * h + k * k - 2 * h * k * s) / (2 * c2))
    return base + float(np.sum(w * f)) / (2 * math.pi)


def _chi2_bvn(rho: float, px: np.ndarray, py: np.ndarray, n: float) -> float:
    ex = [_nppf(v) for v in np.concatenate([[0.0], np.cumsum(px)])]
    ey = [_nppf(v) for v in np.concatenate([[0.0], np.cumsum(py)])]
    grid = np.array([[_bvn_cdf(a, b, rho) for b in ey] for a in ex])
    cell = grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]
    ind = np.outer(px, py)
    return float(n * np.sum((cell - ind) ** 2 / ind))


def phik_from_table(counts: np.ndarray) -> float:
    """φ_K of one contingency table (Baak et al., arXiv:1811.11440): the
    correlation of a bivariate normal whose binned χ², plus the χ² that
    independent data would show (its degrees of freedom), equals the observed
    χ².  Solved by bisection on [0, 1]."""
    counts = counts[counts.sum(axis=1) > 0][:, counts.sum(axis=0) > 0]
    if counts.shape[0] < 2 or counts.shape[1] < 2:
        return 0.0
    n = counts.sum()
    px, py = counts.sum(axis=1) / n, counts.sum(axis=0) / n
    expected = np.outer(px, py) * n
    chi2 = float(np.sum((counts - expected) ** 2 / expected))
    pedestal = (counts.shape[0] - 1) * (counts.shape[1] - 1)
    goal = chi2 - pedestal
    if goal <= 0:
        return 0.0
    hi_rho = 0.9999
    if _chi2_bvn(hi_rho, px, py, n) <= goal:
        return 1.0
    lo, hi = 0.0, hi_rho
    for _ in range(40):
        mid = (lo + hi) / 2
        if _chi2_bvn(mid, px, py, n) < goal:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


# Acklam's rational approximation of the normal quantile (relative error below 1.2e-9).
PPF_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
PPF_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01)
PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00)
PPF_LOW = 2.425e-02

#: Correlations looked at per pass, passes, and the largest correlation that is told from 1.
PHIK_POINTS, PHIK_PASSES, PHIK_TOP = 24, 5, 0.9999


def _num(x: float) -> str:
    return f"({x:.17e})"


def ppf_sql(p: str) -> str:
    """Standard normal quantile of ``p`` in (0, 1), as SQL that Spark and other engines read alike."""
    def poly(cs, x):
        out = _num(cs[0])
        for c in cs[1:]:
            out = f"({out} * {x} + {_num(c)})"
        return out
    low, high = f"sqrt(-2e0 * ln({p}))", f"sqrt(-2e0 * ln(1e0 - {p}))"
    mid, r = f"({p} - 5e-1)", f"(({p} - 5e-1) * ({p} - 5e-1))"
    tail = lambda q: f"{poly(PPF_C, q)} / {poly((*PPF_D, 1.0), q)}"
    return (f"CASE WHEN {p} < {_num(PPF_LOW)} THEN {tail(low)} WHEN {p} > {_num(1 - PPF_LOW)} THEN -({tail(high)}) "
            f"ELSE {mid} * {poly(PPF_A, r)} / {poly((*PPF_B, 1.0), r)} END")


def corner_sql(h: str, k: str, rho: str) -> str:
    """What the correlation ``rho`` adds to P(X <= h, Y <= k) of a standard bivariate normal: Gauss-Legendre over the angle, as SQL."""
    terms = []
    for x, w in zip(_GL_X, _GL_W):
        u = _num((x + 1) / 2)
        terms.append(f"{_num(w / 2)} * exp(-({h} * {h} + {k} * {k} - 2e0 * {h} * {k} * sin({u} * asin({rho}))) / (2e0 * cos({u} * asin({rho})) * cos({u} * asin({rho}))))")
    return f"asin({rho}) * ({' + '.join(terms)}) / {_num(2 * math.pi)}"


# A column's most frequent values that ``phik_table(values=n)`` keeps; the rest is one category.
REST = "\x00rest"


def _most_frequent(ct: DataFrame, values: int) -> DataFrame:
    for v in ("va", "vb"):
        w = Window.partitionBy("a", "b").orderBy(F.desc("n"), v)
        top = (ct.groupBy("a", "b", v).agg(F.sum("n").alias("n")).withColumn("_r", F.row_number().over(w))
               .where(F.col("_r") <= values).select("a", "b", v, F.lit(True).alias("_top")))
        ct = (ct.join(top, ["a", "b", v], "left").withColumn(v, F.when(F.col("_top"), F.col(v)).otherwise(F.lit(REST)))
              .groupBy("a", "b", "va", "vb").agg(F.sum("n").alias("n")))
    return ct


def _bounds(ct: DataFrame, v: str, place: str, bound: str) -> DataFrame:
    """Per pair and value of one side, in the values' order (numbers first, as numbers): its place, its share, the next
    value's share, and the normal quantile of its upper bound (none for the last)."""
    order = Window.partitionBy("a", "b").orderBy(F.expr(f"try_cast({v} AS double)").asc_nulls_last(), v)
    whole = Window.partitionBy("a", "b")
    m = ct.groupBy("a", "b", v).agg(F.sum("n").cast("double").alias("m"))
    m = m.select("a", "b", F.row_number().over(order).alias(place), (F.col("m") / F.sum("m").over(whole)).alias(f"p{place}"),
                 (F.lead("m").over(order) / F.sum("m").over(whole)).alias(f"q{place}"),
                 (F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("m").over(whole)).alias("cum"))
    return m.where(F.col(f"q{place}").isNotNull()).select("a", "b", place, f"p{place}", f"q{place}", F.expr(ppf_sql("cum")).alias(bound))


def phik_table(ct: DataFrame, values: int | None = None) -> DataFrame:
    """D16 φ_K per pair (Baak et al., arXiv:1811.11440): ``(a, b, phik)``.

    The correlation of a bivariate normal whose χ² over the pair's cells, plus the χ² that independent data would show (its
    degrees of freedom), equals the observed one.  All pairs are solved together on rows: a pair's corners come from a
    join of its two margins, so one with many values is many tasks; the driver holds two numbers per pair.
    ``values``: keep that many most frequent values of a column and make the rest one category (none: all values)."""
    ct = stored_cells(ct if values is None else _most_frequent(ct, values))
    spark = ct.sparkSession
    observed = chi2_table(ct).collect()  # a row per pair of columns
    goal = {(r["a"], r["b"]): r["chi2"] - r["dof"] for r in observed}
    size = {(r["a"], r["b"]): r["n"] for r in observed}
    done = {k: 0.0 for k, g in goal.items() if g <= 0}
    left = {k: (0.0, PHIK_TOP) for k in goal if k not in done}
    if left:
        corners = _bounds(ct, "va", "i", "h").join(_bounds(ct, "vb", "j", "k"), ["a", "b"])
        ensure_checkpoint_dir(spark)
        corners = corners.checkpoint(eager=True)
    for step in range(PHIK_PASSES if left else 0):
        points = PHIK_POINTS + (step == 0)  # the first pass looks at the top as well
        rhos = {(key, p): lo + (hi - lo) * p / (PHIK_POINTS + 1) for key, (lo, hi) in left.items() for p in range(1, points + 1)}
        looked = spark.createDataFrame([(a, b, p, r) for ((a, b), p), r in rhos.items()], "a string, b string, p int, rho double")
        chi2 = {((r["a"], r["b"]), r["p"]): r["s"] * size[r["a"], r["b"]] for r in _cell_sums(corners, F.broadcast(looked)).collect()}
        for key, (lo, hi) in list(left.items()):
            below = [rhos[key, p] for p in range(1, points + 1) if chi2[key, p] < goal[key]]
            if step == 0 and len(below) == points:
                done[key] = 1.0
                del left[key]
                continue
            above = [rhos[key, p] for p in range(1, points + 1) if chi2[key, p] >= goal[key]]
            left[key] = (max([lo, *below]), min([hi, *above]))
    done |= {k: (lo + hi) / 2 for k, (lo, hi) in left.items()}
    return spark.createDataFrame([(a, b, v) for (a, b), v in sorted(done.items())], "a string, b string, phik double")


def _cell_sums(corners: DataFrame, looked: DataFrame) -> DataFrame:
    """Σ (cell − independent)² / independent per pair and correlation: a corner counts in four cells, with sign."""
    q = corners.join(looked, ["a", "b"]).withColumn("q", F.expr(corner_sql("h", "k", "rho")))
    cells = F.array(*[F.struct((F.col("i") + x).alias("i"), (F.col("j") + y).alias("j"), (F.col("q") * (1 if x == y else -1)).alias("d"),
                               (F.col("qi" if x else "pi") * F.col("qj" if y else "pj")).alias("e")) for x in (0, 1) for y in (0, 1)])
    per_cell = q.select("a", "b", "p", F.inline(cells)).groupBy("a", "b", "p", "i", "j").agg(F.sum("d").alias("d"), F.min("e").alias("e"))
    return per_cell.groupBy("a", "b", "p").agg(F.sum(F.col("d") * F.col("d") / F.col("e")).alias("s"))


def association_matrix(df: DataFrame, num: Sequence[str], cat: Sequence[str], bins: int = 10,
                       method: str = "cramers_v") -> DataFrame:
    """Symmetric long-form matrix ``(column_a, column_b, value)`` with the
    diagonal set to 1."""
    ct = stored_cells(contingency(df, num, cat, bins))
    if method == "phik":
        vals = phik_table(ct).select("a", "b", F.col("phik").alias("value"))
    elif method == "cramers_v":
        vals = chi2_table(ct).select("a", "b", F.col("cramers_v").alias("value"))
    else:
        raise ValueError(f"unknown method {method!r}")
    names = list(num) + list(cat)
    spark = df.sparkSession
    diag = spark.createDataFrame([(c, c, 1.0) for c in names], "column_a string, column_b string, value double")
    both = (vals.select(F.col("a").alias("column_a"), F.col("b").alias("column_b"), "value")
            .unionByName(vals.select(F.col("b").alias("column_a"), F.col("a").alias("column_b"), "value")))
    return both.unionByName(diag)


def add_flag(role_table: DataFrame, flags: DataFrame, name: str = "Phik_high_target", default: str = "unk") -> DataFrame:
    """The role table with the high-association flag as a column (one row
    per source column on both sides)."""
    return (role_table.drop(name).join(flags.select("Column_Name", name), "Column_Name", "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(default))))


def flag_high(matrix: DataFrame, target: str, threshold: float = 0.85) -> DataFrame:
    """Columns whose |association| with the target exceeds the
    threshold (target itself excluded), by *name*."""
    return (matrix.where((F.col("column_b") == target) & (F.col("column_a") != target)
                         & (F.abs(F.col("value")) > threshold))
            .select(F.col("column_a").alias("Column_Name"), F.lit("true").alias("Phik_high_target")))


def unique_pairs(matrix: DataFrame) -> DataFrame:
    """Each unordered pair once (self pairs dropped), highest first: the matrix is symmetric, so the triangle with the
    lesser name first is all of it."""
    return matrix.where(F.col("column_a") < F.col("column_b")).select("column_a", "column_b", "value").orderBy(F.desc("value"), "column_a", "column_b")
