import hashlib
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from rosterline.llm import nearest_neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, is_query, k):
    """Rank, id and cosine of the nearest usable rows, by id where cosines are equal."""
    usable = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            usable[i] = np.asarray(v, np.float32).astype(float)
    ids = sorted(usable)
    unit = np.array([usable[i] / np.linalg.norm(usable[i]) for i in ids])
    out = {}
    for place, i in enumerate(ids):
        if is_query(i):
            near = sorted((-round(float(unit[place] @ unit[j]), 12), ids[j]) for j in range(len(ids)) if j != place)
            out[i] = [(rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return out


def searched(df, condition, k):
    out = {}
    for r in nn.search(df, condition, k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 12)))
    return out


def test_edges_and_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(60)]
    rows += [(100 + i, list(rows[7][1])) for i in range(30)]  # one vector that many rows share
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0, 0, 0, 0]), (204, [float("nan")] * 6), (205, [float("inf")] + [1.0] * 5), (206, [1.0, 2.0]), (None, [1.0] * 6), (3, list(rows[3][1]))]
    df = spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], 0) for i, v in rows], SCHEMA).withColumn("score", F.lit(1)).withColumn("gid", F.lit(2))
    usable = [r for r in rows if not (r[1] and len(r[1]) == 2)]
    assert searched(df, F.col("vec_id") % 5 == 0, 4) == brute_force(usable, lambda i: i % 5 == 0, 4)
    assert nn.search(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 1.0], 0), (3, [0.0, 1.0], 0)], SCHEMA)
    assert searched(few, F.col("vec_id") == 1, 5) == {1: [(1, 2, round(0.5**0.5, 12)), (2, 3, 0.0)]}


def test_recall_over_small_windows(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 64)
    monkeypatch.setattr(nn, "LEAST_WINDOW", 64)
    monkeypatch.setattr(nn, "CHUNK", 16)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 16))
    rows = [(i, [float(x) for x in centres[i % 40] + 0.3 * rng.standard_normal(16)]) for i in range(1600)]
    expected = brute_force(rows, lambda i: i % 50 == 0, 5)
    found = searched(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") % 50 == 0, 5)
    hits = sum(len({j for _, j, _ in expected[i]} & {j for _, j, _ in found[i]}) for i in expected)
    assert found.keys() == expected.keys() and hits >= 0.9 * 5 * len(expected)


def test_windows_are_exact_and_merged_once(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 16)
    monkeypatch.setattr(nn, "SEGMENT", 40)
    monkeypatch.setattr(nn, "LEAST_WINDOW", 20)
    monkeypatch.setattr(nn, "CHUNK", 3)
    rng = np.random.default_rng(6)
    orders = [np.arange(100), rng.permutation(100), rng.permutation(100)]
    rows = [(o, rank, int(place)) for o, order in enumerate(orders) for rank, place in enumerate(order)]
    ranks = spark.createDataFrame(rows, "ordering int, rank long, place long")
    asked = [0, 13, 50, 99]
    found = nn.candidates(ranks, spark.createDataFrame([(p,) for p in asked], "place long"), 100, len(asked)).collect()
    for query in asked:
        expected = set()
        for order in orders:
            at = int(np.flatnonzero(order == query)[0])
            expected |= {int(p) for p in order[max(at - 10, 0) : at + 11]}
        got = [int(p) for r in found if r["query"] == query for p in np.frombuffer(r["places"], "<u4")]
        assert len(got) == len(set(got)) and set(got) == expected
    assert all({int(p) // 16 for p in np.frombuffer(r["places"], "<u4")} == {r["block"]} for r in found)


def test_hilbert_curve_visits_every_cell_by_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = nn.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def slow_search(rows, asked, k):
    """Ids and cosines by whole lists of candidates: every ordering sorted at once, its windows merged, each candidate scored."""
    rows = sorted(rows, key=lambda r: hashlib.md5(np.asarray(r[1], np.float32).tobytes()).hexdigest())
    ids, unit = np.array([r[0] for r in rows]), nn._unit(np.array([r[1] for r in rows], np.float32).astype(float))
    keys = nn._keys(unit, *nn._turns(unit[: nn.FIT_ROWS]))
    assert all(len(set(key)) == len(rows) for key in keys.tolist())  # else the order of equal keys would count
    half = max(nn.LEAST_WINDOW, int(np.ceil(len(rows) * nn.WINDOW_SHARE))) // 2
    ranks = np.argsort(np.argsort(keys, axis=1), axis=1)
    out = {}
    for at in np.flatnonzero(np.isin(ids, asked)):
        near = (np.abs(ranks - ranks[:, at : at + 1]) <= half).any(axis=0)
        near[at] = False
        score = (unit * unit[at]).sum(axis=1)
        best = sorted((-score[j], ids[j]) for j in np.flatnonzero(near))[:k]
        out[ids[at]] = [(n, j, round(-s, 12)) for n, (s, j) in enumerate(best, 1)]
    return out


def test_neighbours_are_the_best_of_all_windows(spark, monkeypatch):
    for name, value in dict(BLOCK=64, CHUNK=20, SEGMENT=150, RANGE=300, PACKED=100, ROUND=16, FIT_ROWS=500).items():
        monkeypatch.setattr(nn, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(24).astype(np.float32)]) for i in range(1100)]
    found = searched(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") % 20 == 0, 5)
    assert found == slow_search(rows, range(0, 1100, 20), 5)


def test_sample_has_the_smallest_keys(spark, monkeypatch):
    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(900)]
    entries = spark.createDataFrame([(i, key, b"%d" % i) for i, key in enumerate(keys)], "place long, key string, vec binary")
    for rows, n in ((100, 900), (100, 900_000), (450, 900), (2000, 900)):  # also where too few keys are below the bound
        monkeypatch.setattr(nn, "FIT_ROWS", rows)
        expected = sorted(range(900), key=keys.__getitem__)[:rows]
        assert nn._sample(entries, n)["place"].tolist() == expected


def test_best_of_a_task_with_ties(monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 32)
    monkeypatch.setattr(nn, "QUERY_TILE", 7)
    rng = np.random.default_rng(11)
    vectors = nn._unit(rng.standard_normal((400, 8)))
    vectors[200:300] = vectors[100:200]  # as of vectors that differ by a factor
    firsts, ranks = rng.permutation(400), np.stack([rng.permutation(400) for _ in range(3)]).astype("<u4")
    best = nn._Best(vectors[:50], ranks[:, :50], 4, 30)
    for at in range(0, 400, 90):
        best.meet(np.arange(at, min(at + 90, 400)), firsts[at : at + 90], vectors[at : at + 90], ranks[:, at : at + 90])
    for query in range(50):
        met = np.flatnonzero((np.abs(ranks.astype(int) - ranks[:, query : query + 1].astype(int)) <= 30).any(axis=0))
        expected = sorted((-(vectors[j] * vectors[query]).sum(), firsts[j], j) for j in met)[:5]
        assert [(-s, f, j) for s, f, j in zip(best.score[query], best.first[query], best.place[query])] == expected


def test_ranks_are_exact_across_ranges_of_equal_keys():
    rng = np.random.default_rng(9)
    keys, places = rng.integers(0, 4, 500), rng.permutation(500)
    order = np.lexsort((places, keys))
    ends = order[[60, 100, 290, 300, 420]]
    range_ = nn._ranges(keys, places, (keys[ends], places[ends]))
    assert (range_[order] == np.searchsorted([60, 100, 290, 300, 420], np.arange(500), "right")).all()
    of = range_ == 2
    group = pd.DataFrame({"ordering": 7, "range": 2, "keys": [keys[of].tobytes()], "places": [places[of].astype("<u4").tobytes()]})
    ranks = {}
    for r in nn._sorted_range(64, "<u4")(group).itertuples():
        ranks |= dict(zip((np.frombuffer(r.at, "<u2") + r.segment * 64).tolist(), np.frombuffer(r.ranks, np.uint32).tolist()))
    assert ranks == {int(p): n for n, p in enumerate(places[order[100:290]])}


def test_disk_does_not_follow_the_candidates(spark, monkeypatch):
    written, write = {}, DataFrameWriter.parquet

    def counted(self, path, *args, **more):
        write(self, path, *args, **more)
        written[path] = sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    rng = np.random.default_rng(10)
    stored = []
    for n in (1500, 6000):
        written.clear()
        vectors = rng.standard_normal((n, 16)).tolist()
        assert nn.search(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA), F.lit(True), 5).count() == 5 * n
        stored.append(sum(written.values()))
    # The candidates are 16 times as many, half of all pairs: 72 MB where they are stored.
    assert stored[1] < 6 * stored[0] and stored[1] < 12e6
