"""Vectors as bytes, without those that have no direction, and with exact copies folded into one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.plans.lineage import cut, spread

#: Bytes of vectors that are broadcast at once.
SENT = 64 << 20
#: Leaders at most, and the angle within which a vector is near to one.
LEADERS, NEAR = 4096, 0.8


def _sound(v: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whether each list can be used, its length, where it begins among the elements, the elements of all lists)."""
    n = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    x = pc.fill_null(v.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    begin, good = np.cumsum(n) - n, n > 0
    if good.any():
        at = begin[good]
        good[good] = np.logical_and.reduceat(np.isfinite(x), at) & np.logical_or.reduceat(x != 0, at)
    return good, n, begin, x


def usable(df: DataFrame, key: str, column: str) -> DataFrame:
    """(id, vec): vectors as float32 bytes. Left out: null, empty and all-zero ones, those with null or non-finite
    elements, and those whose length isn't the commonest one (it can't be compared)."""
    kept = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").cast("array<float>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, n, _, _ = _sound(batch.column("v"))
            sizes, times = np.unique(n[good], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(times, pa.int64())], ["n", "times"])

    sizes = kept.select("v").mapInArrow(lengths, "n long, times long").groupBy("n").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "n").limit(1).collect()
    dim = sizes[0]["n"] if sizes else 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, n, begin, x = _sound(batch.column("v"))
            good &= n == dim
            rows = np.ascontiguousarray(x[begin[good][:, None] + np.arange(dim)], dtype=np.float32)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (4 * dim)
            vec = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(good)), vec], ["id", "vec"])

    return spread(kept.mapInArrow(pack, "id long, vec binary"))


def fold(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct vectors (id of the smallest copy, vec, copies), members (rep, id)).

    Copies are told by a digest, counted with map-side aggregation, so any number of them is cheap."""
    keyed = cut(vectors.withColumn("d", F.sha2("vec", 256)), "vectors")
    reps = keyed.groupBy("d").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = cut(keyed.select("d", "id").join(reps.select("d", "rep"), "d").select("rep", "id"), "members")
    distinct = cut(keyed.join(reps.select("d", F.col("rep").alias("id"), "copies"), ["d", "id"]).select("id", "vec", "copies"), "distinct-vectors")
    return distinct, members


def first_ids(members: DataFrame, k: int) -> DataFrame:
    """The k smallest ids of each fold; the limit is applied before rows are exchanged."""
    w = Window.partitionBy("rep").orderBy("id")
    return members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")


def matrix(blobs) -> np.ndarray:
    """Rows of float32 from their bytes."""
    blobs = list(blobs)
    return np.frombuffer(b"".join(blobs), dtype=np.float32).reshape(len(blobs), -1) if blobs else np.zeros((0, 1), np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    """Orthonormal random directions (as many as the dimension allows), the same everywhere for a seed."""
    g = np.random.default_rng(seed).standard_normal((dim, max(1, min(count, dim))))
    return np.linalg.qr(g)[0]


def slack(dim: int) -> float:
    """Bound on the error of an inner product of unit vectors of single precision, whatever the order of its sum."""
    return (dim + 4) * 6e-8


def margin(dim: int) -> float:
    """Bound on the error of a sum of up to four angles taken from inner products of single precision."""
    return 4 * (2 * slack(dim)) ** 0.5


def angles(products: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(products, -1, 1))


def led(vectors: DataFrame, leaders: np.ndarray) -> DataFrame:
    """vectors (id, vec, ...) with ``cell``, the nearest of the leaders (unit rows), -1 if none is within NEAR, and
    ``phi``, the angle to the nearest. Leaders decide only how much can be passed over, never what is found."""
    shared = vectors.sparkSession.sparkContext.broadcast(leaders.astype(np.float32))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell, phi = np.zeros(len(pdf), np.int32), np.full(len(pdf), np.pi, np.float32)
                u = unit(matrix(pdf["vec"])).astype(np.float32)
                for lo in range(0, len(pdf) if len(shared.value) else 0, 2048):
                    p = u[lo : lo + 2048] @ shared.value.T
                    cell[lo : lo + 2048] = best = p.argmax(axis=1)
                    phi[lo : lo + 2048] = angles(p[np.arange(len(p)), best])
                yield pdf.assign(cell=np.where(phi <= NEAR, cell, -1).astype(np.int32), phi=phi)

    kinds = ", ".join(f"{name} {kind}" for name, kind in vectors.dtypes)
    return vectors.mapInPandas(place, f"{kinds}, cell int, phi float")


class Sections:
    """Vectors of a pass in sections: of one cell and about one angle each, or of far vectors in the order asked for.

    A vector q at the angle t to a section's leader is at least t less the section's largest angle from every vector in
    it; and one at the angle a to its own nearest leader is at least the section's least angle less a from them, since
    none of them is nearer to any leader."""

    def __init__(self, part: pd.DataFrame, far_order: str, leaders: np.ndarray, extra: str | None) -> None:
        cell, phi = part["cell"].to_numpy(), part["phi"].to_numpy()
        ring = np.where(cell < 0, 0, phi // 0.2).astype(np.int64)
        order = np.lexsort((np.where(cell < 0, part[far_order].to_numpy(), phi), ring, cell))
        cell, phi, ring = cell[order], phi[order], ring[order]
        self.ids, self.x = part["id"].to_numpy(np.int64)[order], matrix(part["vec"].to_numpy()[order])
        self.extra = part[extra].to_numpy(np.int64)[order] if extra else None
        edges = np.nonzero((cell[1:] != cell[:-1]) | (ring[1:] != ring[:-1]))[0] + 1
        runs = [0, *edges.tolist(), len(cell)]
        self.bounds = [(lo, min(lo + 4096, b)) for a, b in zip(runs, runs[1:]) for lo in range(a, b, 4096)]
        self.cell = np.array([cell[lo] for lo, _ in self.bounds])
        self.least = np.array([phi[lo:hi].min() for lo, hi in self.bounds])
        self.most = np.array([phi[lo:hi].max() for lo, hi in self.bounds])
        used, self.at = np.unique(np.maximum(self.cell, 0), return_inverse=True)
        self.leaders = leaders[used].astype(np.float32) if len(leaders) else np.zeros((1, self.x.shape[1]), np.float32)

    def single(self, k: int) -> np.ndarray:
        """Unit vectors of a section in single precision."""
        held = self.__dict__.setdefault("_single", {})
        if k not in held:
            lo, hi = self.bounds[k]
            held[k] = unit(self.x[lo:hi]).astype(np.float32)
        return held[k]

    def open(self, q: np.ndarray, phi: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Rows of ``q`` (unit, single precision) x sections: whether a vector within the angle ``reach`` may be there."""
        reach = reach[:, None] + margin(q.shape[1])
        out = self.least[None, :] - phi[:, None] <= reach
        near = self.cell >= 0
        if near.any():
            t = angles(q @ self.leaders.T)[:, self.at[near]]
            out[:, near] &= t - self.most[None, near] <= reach
        return out


def sent(vectors: DataFrame, leaders: np.ndarray, far_order: str = "phi", extra: str | None = None) -> Iterator:
    """Broadcasts of Sections that together hold all vectors (id, vec, cell, phi), of at most about SENT bytes each:
    whole cells, the larger ones in parts."""
    spark = vectors.sparkSession
    sizes = vectors.groupBy("cell").agg(F.sum(F.length("vec")).alias("b")).orderBy("cell").collect()  # a row a leader
    passes, first, held = [], None, 0
    for cell, size in ((r["cell"], r["b"]) for r in sizes):
        if held and held + size > SENT:
            passes.append((F.col("cell") >= first) & (F.col("cell") < cell))
            first, held = None, 0
        if size > SENT:
            parts = -(-size // SENT)
            passes += [(F.col("cell") == cell) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == r) for r in range(parts)]
        else:
            first, held = (cell if first is None else first), held + size
    if held:
        passes.append(F.col("cell") >= first)
    names = list(dict.fromkeys(["id", "vec", "cell", "phi", *([extra] if extra else []), far_order]))
    for these in passes:
        part = vectors.where(these).select(*names).toPandas()
        if len(part):
            yield spark.sparkContext.broadcast(Sections(part, far_order, leaders, extra))
