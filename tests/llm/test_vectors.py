from __future__ import annotations

import numpy as np
import pytest

from lumbrera.llm import groups as G
from lumbrera.llm import neighbours as N


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "c", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, nb int")


def planted(seed=0, groups=12, dim=24):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        c = rng.normal(size=dim)
        c /= np.linalg.norm(c)
        out += [c * 1.3 + rng.normal(size=dim) * 0.03 for _ in range(4 + 5 * g)]
    out += list(rng.normal(size=(60, dim)))
    return np.array(out, dtype=np.float32)


def truth(x, ids, k, floor):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = (u @ u.T).round(9)
    np.fill_diagonal(s, -2)
    pairs = set()
    for i in range(len(x)):
        c = [j for j in np.lexsort((ids, -s[i])) if s[i, j] >= floor][:k]
        pairs |= {(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in c}
    return s, pairs


def test_neighbours_against_brute_force(spark):
    x = planted()
    x = np.concatenate([x, x[:9], x[5:6], x[5:6]])  # copies
    ids = np.random.default_rng(1).permutation(len(x)) * 3
    df = table(spark, [*zip(ids.tolist(), x), (9001, None), (9003, np.zeros(24)), (9005, []), (9007, [float("nan")] * 24)])
    got = {(r["vec_a"], r["vec_b"]) for r in N.pairs(N.most_similar(df, k=5, floor=0.8)).collect()}
    _, want = truth(x, ids, 5, 0.8)
    assert len(got & want) / len(want) > 0.99 and len(got & want) / len(got) > 0.99


def test_recall_with_narrow_windows(spark):
    x = planted(3, groups=30)
    ids = np.arange(len(x))
    got = {(r["vec_a"], r["vec_b"]) for r in N.pairs(N.most_similar(table(spark, list(zip(ids.tolist(), x))), k=5, floor=0.8, block=32, reach=96)).collect()}
    _, want = truth(x, ids, 5, 0.8)
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("size", [64 << 20, 40_000])
def test_neighbours_exact_in_a_group_beyond_the_windows(spark, monkeypatch, size):
    from lumbrera.llm import vectors

    monkeypatch.setattr(vectors, "SENT", size, raising=False)  # the small one takes several passes
    rng = np.random.default_rng(7)
    c = rng.normal(size=24)
    x = (c / np.linalg.norm(c) * 6 + rng.normal(size=(1500, 24)) * 0.5).astype(np.float32)
    ids = rng.permutation(1500)
    got = {(r["vec_a"], r["vec_b"]) for r in N.pairs(N.most_similar(table(spark, list(zip(ids.tolist(), x))), k=5, floor=0.8, block=16, reach=16)).collect()}
    assert got == truth(x, ids, 5, 0.8)[1]


def test_windows_do_not_depend_on_the_ranges(spark):
    x = planted(6, groups=14)
    distinct, _ = N.fold(N.usable(table(spark, list(enumerate(x))), "vec_id", "embedding"))
    got = [{(r["id"], p["nb"]) for r in N.window_neighbours(distinct, 4, 0.8, curves=2, block=16, reach=40, length=length).collect() for p in r["a"]} for length in (80, 100_000)]
    assert got[0] == got[1] and got[0]  # every range has a halo of its neighbours' rows


def test_windows_alone_and_vectors_asked_again(spark):
    rng = np.random.default_rng(3)
    c = rng.normal(size=24)
    x = (c / np.linalg.norm(c) * 6 + rng.normal(size=(900, 24)) * 0.5).astype(np.float32)
    df = table(spark, list(enumerate(x)))
    some = N.recall(df, every=3, block=64, reach=10, met=0.0).collect()[0]
    whole = N.recall(df, every=3, block=64, reach=10).collect()[0]
    assert some["asked"] == 300 and some["wanted"] == 1500
    assert some["recall"] < 0.9 and whole["recall"] > 0.98, (some, whole)


def test_all_copies(spark):
    df = table(spark, [(i, [1.0, 2.0, 2.0]) for i in range(30)])
    rows = N.most_similar(df, k=3).orderBy("id", "rank").collect()
    assert [r["nb"] for r in rows if r["id"] == 0] == [1, 2, 3] and [r["nb"] for r in rows if r["id"] == 2] == [0, 1, 3] and len(rows) == 90


def test_empty_and_single(spark):
    assert N.most_similar(table(spark, [])).count() == 0
    assert N.most_similar(table(spark, [(1, [1.0, 0.0])])).count() == 0
    assert N.most_similar(table(spark, [(1, None), (2, [0.0, 0.0])])).count() == 0
    assert G.group_vectors(table(spark, [])).count() == 0
    assert [tuple(r)[:2] for r in G.group_vectors(table(spark, [(7, [1.0, 0.0])])).collect()] == [(7, 7)]


def test_hilbert_visits_neighbours():
    bits = 3
    cells = np.array([(i, j) for i in range(8) for j in range(8)])
    order = cells[np.argsort(N.hilbert(cells, bits))]
    assert len(set(N.hilbert(cells, bits))) == 64
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("chunk", [3072, 17])
def test_groups_against_brute_force(spark, monkeypatch, chunk):
    x = planted(5)
    x = np.concatenate([x, x[:3]])
    ids = np.arange(len(x)) * 2 + 1
    df = table(spark, [*zip(ids.tolist(), x), (9002, None), (9004, np.zeros(24))])
    s, _ = truth(x, ids, 5, 0.8)
    label = list(range(len(x)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in zip(*np.nonzero(s >= 0.8)):
        a, b = top(i), top(j)
        if a != b:
            label[max(a, b)] = min(a, b)
    want = {int(ids[i]): int(ids[top(i)]) for i in range(len(x))}
    if chunk != 3072:
        import importlib

        source = importlib.import_module("lumbrera.llm.groups")
        monkeypatch.setattr(source, "CHUNK", chunk)  # hot cells are split; links between parts come through their heads
    got = {r["id"]: r["grupo"] for r in G.group_vectors(df).collect()}
    assert set(got) == set(want)
    assert sum(got[i] == want[i] for i in want) / len(want) > 0.99


def test_adjacent_dense_cells_are_joined(spark):
    x = np.array([[np.cos(t), np.sin(t)] for t in np.linspace(0.0, 1.2, 40)], dtype=np.float32)
    distinct, _ = G.fold(G.usable(table(spark, list(enumerate(x))), "vec_id", "embedding"))
    cells = spark.createDataFrame([(0, 100 + i // 10 * 7, i) for i in range(40)], "grid int, cell long, id long")
    labels = spark.createDataFrame([(i, i // 10 * 10) for i in range(40)], "id long, label long")
    links = {tuple(r) for r in G.adjacent_links(cells, labels, distinct, [(0, 7), (1, 14)], 0.8).collect()}
    assert links == {(0, 10), (10, 20), (20, 30)}


def components_of(x, threshold):
    s, _ = truth(x, np.arange(len(x)), 1, threshold)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(s >= threshold, label, len(x)).min(axis=1))
        if (new == label).all():
            return label.tolist()
        label = new


def test_parts_of_a_split_cell_joined_by_a_bridge(spark, monkeypatch):
    import importlib

    monkeypatch.setattr(importlib.import_module("lumbrera.llm.groups"), "CHUNK", 17)
    rng = np.random.default_rng(4)
    a, b = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
    lobes = [a + rng.normal(size=(90, 24)) * 0.02, 0.5 * a + 0.75**0.5 * b + rng.normal(size=(90, 24)) * 0.02]
    x = np.concatenate([*lobes, [0.75**0.5 * a + 0.5 * b]]).astype(np.float32)
    want = components_of(x, 0.8)
    got = {r["id"]: r["grupo"] for r in G.group_vectors(table(spark, list(enumerate(x))), grids=1, width=50).collect()}
    assert set(want) == {0} and got == dict(enumerate(want))


def test_sparse_chains_with_the_directions_of_a_large_table(spark, monkeypatch):
    import importlib

    monkeypatch.setattr(importlib.import_module("lumbrera.llm.groups"), "grid_dims", lambda n: 14)  # as for 5 million
    rng = np.random.default_rng(11)
    x = []
    for _ in range(6):
        v = rng.normal(size=48)
        for _ in range(25):
            v /= np.linalg.norm(v)
            x.append(v)
            w = rng.normal(size=48)
            w -= (w @ v) * v
            v = 0.81 * v + (1 - 0.81**2) ** 0.5 * w / np.linalg.norm(w)
    x = np.array(x, dtype=np.float32)
    want = components_of(x, 0.8)
    assert len(set(want)) == 6
    assert {r["id"]: r["grupo"] for r in G.group_vectors(table(spark, list(enumerate(x)))).collect()} == dict(enumerate(want))


def test_description(spark):
    x = planted(2, groups=4)
    df = table(spark, list(enumerate(x)))
    rows = G.describe(df, G.group_vectors(df)).collect()
    assert sorted(r["n"] for r in rows) == [9, 14, 19] and all(len(r["tipicos"]) <= 3 and r["tipicos"] for r in rows)


def test_sections_pass_over_only_what_is_too_far():
    import pandas as pd

    from lumbrera.llm import vectors

    rng = np.random.default_rng(5)
    c = rng.normal(size=(6, 48))
    x = vectors.unit(np.concatenate([c[i % 6] + rng.normal(size=48) * (0.2 if i % 7 else 1.5) for i in range(1200)]).reshape(-1, 48).astype(np.float32)).astype(np.float32)
    leaders = vectors.unit(c)
    phi = vectors.angles((x @ leaders.T.astype(np.float32)).max(axis=1))
    cell = np.where(phi <= vectors.NEAR, (x @ leaders.T).argmax(axis=1), -1)
    parts = vectors.Sections(pd.DataFrame({"id": np.arange(1200), "vec": [v.tobytes() for v in x], "cell": cell, "phi": phi}), "phi", leaders, None)
    near = parts.open(x, phi, np.full(1200, np.arccos(0.8)))
    s = x @ x[parts.ids].T >= 0.8
    for k, (lo, hi) in enumerate(parts.bounds):
        assert not (s[:, lo:hi].any(axis=1) & ~near[:, k]).any()
    assert near.mean() < 0.5 and sorted(parts.ids) == list(range(1200))


def test_a_great_group_is_asked_in_its_own_sections_alone(spark):
    from lumbrera.llm import vectors

    rng = np.random.default_rng(8)
    c = rng.normal(size=(8, 48))
    x = np.concatenate([c[i] / np.linalg.norm(c[i]) * 6 + rng.normal(size=(200, 48)) * 0.2 for i in range(8)]).astype(np.float32)
    distinct, _ = N.fold(N.usable(table(spark, list(enumerate(x))), "vec_id", "embedding"))
    leaders = N.leaders_of(distinct)
    parts = [s.value for s in vectors.sent(vectors.led(distinct.select("id", "vec"), leaders), leaders)]
    u = vectors.unit(x).astype(np.float32)
    open_ = np.concatenate([p.open(u, vectors.angles((u @ leaders.T).max(axis=1)), np.full(len(u), np.arccos(0.9))) for p in parts], axis=1)
    assert len(leaders) == 8 and open_.mean() < 0.2
    got = {(r["id"], p["nb"]) for r in N.exact_neighbours(distinct, distinct, 5, 0.8).collect() for p in r["a"]}
    assert {(min(p), max(p)) for p in got} == truth(x, np.arange(len(x)), 5, 0.8)[1]


def test_vectors_asked_again_meet_their_component_alone(spark, monkeypatch):
    rng = np.random.default_rng(12)
    c = rng.normal(size=(7, 48))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    groups = [c[i] * 6 + rng.normal(size=(300 if i == 0 else 120, 48)) * 0.3 for i in range(7)]
    x = np.concatenate([*groups, rng.normal(size=(500, 48))]).astype(np.float32)
    x = x[rng.permutation(len(x))]
    met, exact = [], N.exact_neighbours
    monkeypatch.setattr(N, "exact_neighbours", lambda asked, distinct, k, floor: met.append(distinct.count()) or exact(asked, distinct, k, floor))
    for whole, want in ((16384, []), (200, [300])):
        monkeypatch.setattr(N, "WHOLE", whole, raising=False)
        got = {(r["vec_a"], r["vec_b"]) for r in N.pairs(N.most_similar(table(spark, list(enumerate(x))), k=5, floor=0.8, block=16, reach=16, met=8)).collect()}
        assert got == truth(x, np.arange(len(x)), 5, 0.8)[1] and met == want


def test_usable_vectors(spark):
    odd = [(4, [1.0, None, 0.0]), (5, [float("inf"), 0.0, 0.0]), (6, [1.0, float("nan"), 0.0]), (7, []), (8, None), (9, [0.0, -0.0, 0.0]), (10, [1.0, 2.0]), (None, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), *odd, (2, [0.0, 0.0, -1.0]), (3, [0.5, 0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r["id"]: np.frombuffer(r["vec"], np.float32).tolist() for r in N.usable(df, "vec_id", "embedding").collect()}
    assert got == {1: [1.0, 2.0, 3.0], 2: [0.0, 0.0, -1.0], 3: [0.5, 0.0, 0.0]}
    assert N.usable(df.where("vec_id > 6 AND vec_id < 10"), "vec_id", "embedding").count() == 0


def test_a_vector_that_no_window_met_is_found_by_the_second_windows(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(13)
    c = rng.normal(size=48)
    x = np.concatenate([c / np.linalg.norm(c) * 6 + rng.normal(size=(40, 48)) * 0.3, rng.normal(size=(30, 48))]).astype(np.float32)
    calls, windows = [], N.window_neighbours

    def blind(distinct, *options):
        out = windows(distinct, *options)
        calls.append(distinct.count())
        return out if len(calls) > 1 else out.where("id <> 0").withColumn("a", F.filter("a", lambda p: p["nb"] != 0))

    monkeypatch.setattr(N, "window_neighbours", blind)
    got = {(r["vec_a"], r["vec_b"]) for r in N.pairs(N.most_similar(table(spark, list(enumerate(x))), k=5, floor=0.8)).collect()}
    assert got == truth(x, np.arange(len(x)), 5, 0.8)[1] and calls == [70, 32]
