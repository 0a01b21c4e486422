"""Groups of mutually similar vectors: connected components of the links of cosine >= threshold, exactly.

Several shifted grids quantise random projections of the vectors. SQL counts the cells; a cell with one vector links
nothing. In each dense cell, or part of a hot one, exact cosines link the vectors, and minimum labels are propagated
over the links. Then SQL joins adjacent dense cells: what one label holds in a cell and another in the next cell of any
direction is linked if their first vectors are, and minimum labels are propagated again. A check of every vector with
all those that have another label, in blocked products, follows; it merges labels that a link still joins, so the
result doesn't depend on how many links the grids find. Blocks around the first vectors of the largest labels are passed
over where their angles to it leave no room for a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.llm.vectors import LEADERS, angles, directions, fold, led, matrix, sent, slack, unit, usable
from lumbrera.operators.graph import components
from lumbrera.plans.lineage import cut, spread

#: Grids, cell width, vectors that a cell should hold by chance, rows of a cell compared at once.
GRIDS, WIDTH, CHANCE, CHUNK = 10, 0.2, 300, 3072


def grid_dims(n: int) -> int:
    """Directions of a grid, so that about CHANCE unrelated vectors share a cell: each direction about halves them."""
    return int(min(16, max(2, ceil(log(max(n, 2) / CHANCE) / log(2.1)))))


def _components(x: np.ndarray, threshold: float) -> np.ndarray:
    """Labels (first row of each component) of the graph of pairs with cosine >= threshold, rounded to 9 decimals."""
    n = len(x)
    sims = (x @ x.T).round(9) >= threshold
    degree = sims.sum(axis=1)
    label = np.arange(n)
    seen = degree <= 1
    for i in range(n):
        if not seen[i]:
            seen[i] = True
            front = np.array([i])
            while len(front):
                new = sims[front].any(axis=0) & ~seen
                seen |= new
                label[new] = i
                front = np.nonzero(new)[0]
    return label


def cell_links(cells: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between vectors of a cell that a chain of cosines >= threshold connects within it."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b = [], []
            cell = pdf["cell"].to_numpy()
            ids, x = pdf["id"].to_numpy(), unit(matrix(pdf["vec"]))
            bounds = [0, *(np.nonzero(cell[1:] != cell[:-1])[0] + 1), len(cell)]
            for s, e in zip(bounds, bounds[1:]):
                for lo in range(s, e, CHUNK):
                    hi = min(lo + CHUNK, e)
                    if hi - lo > 1:
                        label = _components(x[lo:hi], threshold)
                        far = np.nonzero(label != np.arange(hi - lo))[0]
                        a.append(ids[lo + label[far]])
                        b.append(ids[lo + far])
            cat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
            return pd.DataFrame({"a": cat(a), "b": cat(b)})

        for pdf in batches:  # rows come sorted by cell: the last cell of a batch waits for the next batch
            held.append(pdf)
            whole = pd.concat(held) if len(held) > 1 else pdf
            if not len(whole):
                continue
            last = whole["cell"].iloc[-1]
            done = whole[whole["cell"] != last]
            rest = whole[whole["cell"] == last]
            if len(rest) >= 2 * CHUNK:
                done, rest = whole, whole[:0]
            held = [rest]
            if len(done):
                yield work(done)
        if held and sum(map(len, held)):
            yield work(pd.concat(held))

    spark = cells.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), spark.sparkContext.defaultParallelism * 4)
    return cells.repartition(n, "cell").sortWithinPartitions("cell", "id").mapInPandas(link, "a long, b long")


def adjacent_links(cells: DataFrame, labels: DataFrame, distinct: DataFrame, steps: list[tuple[int, int]], threshold: float) -> DataFrame:
    """Links (a, b) between labels that hold two vectors or more in adjacent cells, if the cosine of their first vectors
    there is at least the threshold. Cells (grid, cell, id) are adjacent if they differ by one of the grid's ``steps``
    (grid, step); a cell holds few labels by chance, so the join stays near the number of cells times the directions."""
    spark = cells.sparkSession
    parts = cut(cells.join(labels, "id").groupBy("grid", "cell", "label").agg(F.min("id").alias("rep"), F.count("*").alias("m")).where("m > 1"), "dense-parts")
    moves = spark.createDataFrame(steps, "grid int, step long")  # a row a grid and direction
    asked = parts.join(F.broadcast(moves), "grid").select("grid", (F.col("cell") + F.col("step")).alias("cell"), F.col("label").alias("a"), F.col("rep").alias("ra"))
    met = asked.join(parts.select("grid", "cell", F.col("label").alias("b"), F.col("rep").alias("rb")), ["grid", "cell"]).where("a <> b").select("a", "b", "ra", "rb").distinct()
    vec = distinct.select("id", "vec")
    both = met.join(vec.select(F.col("id").alias("ra"), F.col("vec").alias("va")), "ra").join(vec.select(F.col("id").alias("rb"), F.col("vec").alias("vb")), "rb")

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf[["a", "b"]][np.einsum("id,id->i", unit(matrix(pdf["va"])), unit(matrix(pdf["vb"]))).round(9) >= threshold]

    return both.select("a", "b", "va", "vb").mapInPandas(near, "a long, b long")


def label_links(labelled: DataFrame, leaders: np.ndarray, threshold: float) -> DataFrame:
    """Links (a, b) between labels of vectors (id, vec, label, cell, phi) that join all labels with a cosine >= threshold
    between their vectors. Sections whose angles rule such a cosine out, or of the row's own label, are passed over:
    vectors near to a leader meet sections of near ones only, far ones meet both, so each pair is met from one side at
    least. A task emits no link between labels that it has joined before, so no more links than labels."""
    rows = spread(labelled.select("id", "vec", "label", "cell", "phi"), 4)
    out = labelled.sparkSession.createDataFrame([], "a long, b long")
    for shared in sent(labelled, leaders, "label", "label"):

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own = [pdf for pdf in batches if len(pdf)]
            if not own:
                return
            mine = pd.concat(own)
            is_far = mine["cell"].to_numpy() < 0
            mine = mine.iloc[np.lexsort((mine["label"].to_numpy(), np.where(is_far, -1, mine["cell"].to_numpy()), is_far))]
            is_far, phi = mine["cell"].to_numpy() < 0, mine["phi"].to_numpy()
            parts = shared.value
            x, label = parts.x, parts.extra
            q, asked = unit(matrix(mine["vec"])), mine["label"].to_numpy()
            names, at = np.unique(np.concatenate([label, asked]), return_inverse=True)
            c_at, q_at, top = at[: len(label)], at[len(label) :], np.arange(len(names))  # labels in order, what they have become
            least = np.float32(threshold - 1e-9 - slack(x.shape[1]) - 1e-7)
            first, last = (np.array([f(c_at[lo:hi]) for lo, hi in parts.bounds]) for f in (np.min, np.max))
            near = parts.cell >= 0

            def root(i: int) -> int:
                while top[i] != i:
                    top[i] = top[top[i]]
                    i = top[i]
                return i

            a, b = [], []
            split = int((~is_far).sum())
            for lo, hi in [(i, min(i + 512, e)) for s, e in ((0, split), (split, len(q))) for i in range(s, e, 512)]:
                far, qa, q32 = is_far[lo], q_at[lo:hi], q[lo:hi].astype(np.float32)
                open_ = parts.open(q32, phi[lo:hi], np.full(hi - lo, float(angles(np.float64(threshold - 1e-9)))))
                open_ &= ~((first == last)[None, :] & (top[first][None, :] == top[qa][:, None]))
                open_ &= (near[None, :] if not far else near[None, :] | (last[None, :] > qa[:, None]))
                for k in np.nonzero(open_.any(axis=0))[0]:
                    s, rows_at = parts.bounds[k][0], np.nonzero(open_[:, k])[0]
                    hit = q32[rows_at] @ parts.single(k).T >= least
                    if not hit.any():
                        continue
                    r, c = np.nonzero(hit)
                    r = rows_at[r]
                    ca = c_at[s : s + hit.shape[1]]
                    keep = (top[qa[r]] != top[ca[c]]) & ((qa[r] < ca[c]) | bool(far and near[k]))
                    r, c = r[keep], c[keep]
                    while len(r):  # those that a link found meanwhile has joined are left out
                        some, r, c_some, c = r[:65536], r[65536:], c[:65536], c[65536:]
                        good = np.einsum("id,id->i", q[lo + some], unit(x[s + c_some])).round(9) >= threshold
                        joined = False
                        for i, j in np.unique(np.stack([qa[some[good]], ca[c_some[good]]], axis=1), axis=0):
                            u, v = root(i), root(j)
                            if u != v:
                                top[max(u, v)] = min(u, v)
                                a.append(names[i])
                                b.append(names[j])
                                joined = True
                        if joined:
                            while (top != top[top]).any():
                                top = top[top]
                            rest = top[qa[r]] != top[ca[c]]
                            r, c = r[rest], c[rest]
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

        out = out.unionByName(cut(rows.mapInPandas(search, "a long, b long"), "label-links"))
        shared.unpersist()
    return out


def dims_of(vectors: DataFrame) -> int:
    """Elements of the vectors, which all have the same number."""
    first = vectors.select(F.length("vec").alias("b")).limit(1).collect()
    return first[0]["b"] // 4 if first else 1


def group_vectors(df: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = 0.8, grids: int = GRIDS, width: float = WIDTH) -> DataFrame:
    """(id, grupo, copies, rep): the group of every usable vector, named after its smallest id.

    Two vectors belong together if a chain of cosines >= threshold (rounded to 9 decimals) joins them. A vector
    without links is a group of its own; vectors without a direction (null, all-zero, not finite) have none. Copies
    are together. An empty table gives no rows.
    """
    distinct, members = fold(usable(df, key, column))
    n = distinct.count()
    dims = grid_dims(n)

    dim = dims_of(distinct)

    def mix(g: int) -> np.ndarray:  # a cell is a sum over its coordinates, so that the next cell is a step away
        return np.random.default_rng(77 + g).integers(1, 2**54, min(dims, dim), dtype=np.int64)

    def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                u = unit(matrix(pdf["vec"]))
                for g in range(grids):
                    p = u @ directions(u.shape[1], dims, 5000 + g)
                    q = np.floor((p + np.random.default_rng(g).uniform(0, width, p.shape[1])) / width).astype(np.int64)
                    yield pd.DataFrame({"grid": np.int32(g), "cell": (q * mix(g)).sum(axis=1), "id": pdf["id"]})

    cells = cut(distinct.select("id", "vec").mapInPandas(quantise, "grid int, cell long, id long"), "cells")
    dense = cells.groupBy("grid", "cell").agg(F.count("*").alias("size")).where("size > 1")
    placed = cells.join(dense, ["grid", "cell"]).withColumn("salt", F.pmod(F.xxhash64("grid", "cell", "id"), F.ceil(F.col("size") / CHUNK)).cast("long"))
    split = placed.select(F.xxhash64("grid", "cell", "salt").alias("cell"), "id").join(distinct.select("id", "vec"), "id")

    def renamed(labels: DataFrame, links: DataFrame) -> DataFrame:
        merged = components(links).select(F.col("id").alias("label"), F.col("label").alias("to"))
        return cut(labels.join(merged, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")

    labels = renamed(distinct.select("id", F.col("id").alias("label")), cell_links(split, threshold))
    labels = renamed(labels, adjacent_links(cells, labels, distinct, [(g, int(x)) for g in range(grids) for x in mix(g)], threshold))
    largest = labels.groupBy("label").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "label").limit(LEADERS)
    leaders = unit(matrix(r["vec"] for r in largest.join(distinct, largest["label"] == distinct["id"]).orderBy("id").select("vec").collect()))
    labelled = cut(led(distinct.join(labels, "id").select("id", "vec", "label"), leaders), "labelled")
    labels = renamed(labels, label_links(labelled, leaders, threshold))
    of_rep = distinct.select("id", "copies").join(labels, "id").select(F.col("id").alias("rep"), F.col("label").alias("grupo"), "copies")
    return members.join(of_rep, "rep").select("id", "grupo", "copies", "rep")


def describe(df: DataFrame, groups: DataFrame, key: str = "vec_id", column: str = "embedding", typical: int = 3, least: int = 5) -> DataFrame:
    """(grupo, n, tipicos): groups of ``least`` vectors or more with their size and the ids of the vectors closest to
    the middle of their densest cell, ties to the smaller id. Sums per group and dimension are aggregated map-side."""
    vecs = usable(df, key, column)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                u = unit(matrix(pdf["vec"]))
                for g, rows in pdf.reset_index(drop=True).groupby("grupo").groups.items():
                    total = u[np.asarray(rows)].sum(axis=0)
                    yield pd.DataFrame({"grupo": g, "d": np.arange(len(total), dtype=np.int32), "s": total})

    sizes = groups.groupBy("grupo").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    big = cut(groups.select("id", "grupo").join(sizes, "grupo").join(vecs, "id"), "group-vectors")
    middle = big.select("grupo", "vec").mapInPandas(expand, "grupo long, d int, s double").groupBy("grupo", "d").agg(F.sum("s").alias("s"))
    centre = middle.groupBy("grupo").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "s"))), lambda p: p["s"]).alias("centre"))

    @F.pandas_udf("c double, cell long")
    def place(vec: pd.Series, centre: pd.Series) -> pd.DataFrame:
        if not len(vec):
            return pd.DataFrame({"c": np.zeros(0), "cell": np.zeros(0, np.int64)})
        u, c = unit(matrix(vec)), np.stack(centre.to_list())
        q = np.floor(u @ directions(u.shape[1], 4, 5000) / WIDTH * 4).astype(np.int64)
        return pd.DataFrame({"c": ((u * c).sum(axis=1) / np.maximum(np.sqrt((c * c).sum(axis=1)), 1e-12)).round(9), "cell": (q * np.array([1, 1009, 1018081, 1027243729])).sum(axis=1)})

    near = cut(big.join(centre, "grupo").withColumn("p", place("vec", "centre")).select("grupo", "n", "id", "p.c", "p.cell"), "closeness")
    dense = near.groupBy("grupo", "cell").agg(F.count("*").alias("m")).groupBy("grupo").agg(F.max_by("cell", F.struct("m", "cell")).alias("cell"))
    inside = near.join(dense, ["grupo", "cell"])
    w = Window.partitionBy("grupo").orderBy(F.desc("c"), "id")  # the limit below is applied before rows are exchanged
    top = inside.withColumn("r", F.row_number().over(w)).where(F.col("r") <= typical)
    return top.groupBy("grupo").agg(F.first("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda p: p["id"]).alias("tipicos"))
