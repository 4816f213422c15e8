"""The range join against brute force."""

import numpy as np
import pytest

from tabscore.llm import vector_join as vj


def brute(rows, cosine=0.9):
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    u = {i: np.array(rows[i][1], np.float32).astype(float) for i in ok}
    for a in ok:
        for b in ok:
            if a < b and len(u[a]) == len(u[b]) and u[a] @ u[b] / np.sqrt((u[a] @ u[a]) * (u[b] @ u[b])) >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for i in ok:
        low[find(i)] = min(low.get(find(i), 10 ** 9), rows[i][0])
    comp = [low[find(i)] if i in u else rows[i][0] for i in range(len(rows))]
    return sorted(((k, links[i], comp[i], k == comp[i] if k is not None else None) for i, (k, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vj, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.5])).astype(np.float32).tolist()) for i in range(260)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16),
             (2003, [None] + [1.0] * 15), (2004, [float("inf")] + [1.0] * 15), (2005, []), (2006, [1.0, 0.0]), (2007, [2.0, 0.0]), (None, rows[3][1])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, kept string")
    got = sorted((tuple(r) for r in vj.near_vectors(df).collect()), key=str)
    assert got == brute(rows)


def test_chain_and_empty(spark):
    step = np.arccos(0.9) * 0.99
    rows = [(i, [float(np.cos(i * step)), float(np.sin(i * step))]) for i in (3, 1, 2, 0, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {(r.vec_id, r.n_links, r.component_id) for r in vj.near_vectors(df).collect()} == {(0, 1, 0), (1, 2, 0), (2, 2, 0), (3, 2, 0), (4, 1, 0)}
    assert vj.near_vectors(df.limit(0)).count() == 0


def test_components_of_any_size(spark):
    """No square overflows or vanishes."""
    rows = [(1, [1e200, 0.0]), (2, [2e200, 0.0]), (3, [1.0, 0.0]), (4, [1e-300, 1e-301]), (5, [0.0, 1e308]), (6, [1e-320, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vj.near_vectors(df).collect()}
    assert got == {**{i: (4, 1) for i in (1, 2, 3, 4, 6)}, 5: (0, 5)}


def test_component_rounds_read_their_edges_once(spark, monkeypatch):
    """A union of two readings of the same edges doubles the tasks that the driver keeps account of in every round."""
    from tabscore.llm import common
    plans, keep = [], common.keep
    monkeypatch.setattr(common, "keep", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    edges = [(9, 4), (4, 7), (7, 9), (1, 2), (2, 3), (5, 5), (2, 1)]
    out = common.components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (7, 4), (9, 4)]
    assert "Union" not in "".join([*plans, out._jdf.queryExecution().optimizedPlan().toString()])


def test_tasks_hand_over_bounded_pieces(spark, monkeypatch):
    """A vector goes to more blocks the more vectors there are: what a task holds at once must not grow with that.  Every pair meets once."""
    import pyarrow as pa
    frame = type(spark.range(0))
    monkeypatch.setattr(vj, "BLOCK", 16)
    monkeypatch.setattr(vj, "SENT_BYTES", 40_000, raising=False)
    tasks = []
    for name in ("mapInPandas", "mapInArrow"):
        def record(df, run, schema, *a, f=getattr(frame, name), **b):
            tasks.append((run, schema)) if "guest" in schema else None
            return f(df, run, schema, *a, **b)
        monkeypatch.setattr(frame, name, record)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vj.near_vectors(df)
    (run, _), = tasks
    rows = {"v": [v.astype(float).tolist() for v in x], "rep": list(range(300)), "copies": [1] * 300, "h": rng.integers(-2 ** 63, 2 ** 63, 300).tolist()}
    batch = pa.RecordBatch.from_pydict(rows)
    pieces = list(run(iter([batch if hasattr(vj, "rows_of") else batch.to_pandas()])))
    assert len(pieces) > 5 and all((p.num_rows if isinstance(p, pa.RecordBatch) else len(p)) * (8 * 4 + 64) <= 2 * 40_000 for p in pieces)
    blocks, met = {}, {}
    for r in (r for p in pieces for r in p.to_pylist()):
        assert r["x"] == x[r["rep"]].tobytes()
        blocks.setdefault((r["cell"], r["i"], r["j"]), ([], []))[r["guest"]].append(r["rep"])
    for (_, i, j), (left, right) in blocks.items():
        for u in left:
            for v in (left if i == j else right):
                if u != v and (i != j or u < v):
                    met[min(u, v), max(u, v)] = met.get((min(u, v), max(u, v)), 0) + 1
    unit = vj.unit(x.astype(float))
    near = {(int(u), int(v)) for u, v in zip(*np.nonzero(unit @ unit.T >= 0.9)) if u < v}
    assert near and near <= set(met) and set(met.values()) == {1}


def test_blocks_hold_bounded_bytes(spark, monkeypatch):
    """Long vectors meet in smaller blocks; results stay."""
    monkeypatch.setattr(vj, "BLOCK_BYTES", 20 * 8 * 40)
    monkeypatch.setattr(vj, "PAIRS", 50)
    monkeypatch.setattr(vj, "NUMBERS", 100)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(5, 40))
    rows = [(i, (base[i % 5] + rng.normal(size=40) * 0.2).tolist()) for i in range(60)]
    a = vj.unit([v for _, v in rows])
    counts, edges = vj.block_links(np.arange(60), a, np.ones(60, np.int64), None, None, None, 0.9)
    assert dict(counts) == {i: int(n) - 1 for i, n in enumerate((a @ a.T >= 0.9).sum(1)) if n > 1} and len(edges) >= 5
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in vj.near_vectors(df).collect()), key=str) == brute(rows)
