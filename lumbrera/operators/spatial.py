"""Points in the plane: tiles, rings, votes of neighbours, holes."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbrera.operators.relational import top_per


def extent(points: DataFrame) -> DataFrame:
    """One row: the smallest x and y and the larger of the two ranges."""
    return points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("range"))


def tiles(points: DataFrame, g: int = 64) -> DataFrame:
    """Adds tx, ty: the cell of a square grid of g x g over the points; the largest coordinates fall in the last one."""
    p = points.crossJoin(F.broadcast(extent(points)))  # one row
    cell = F.col("range") / g * 1.0001
    at = lambda c, o: F.least(F.coalesce(F.floor(F.try_divide(F.col(c) - F.col(o), cell)), F.lit(0)), F.lit(g - 1)).cast("int")
    return p.withColumn("tx", at("x", "x0")).withColumn("ty", at("y", "y0")).drop("x0", "y0", "range")


def moved(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, tx, ty, new_tx, new_ty) of points that changed their tile."""
    b = after.select(key, F.col("tx").alias("new_tx"), F.col("ty").alias("new_ty"))
    return before.select(key, "tx", "ty").join(b, key).where((F.col("tx") != F.col("new_tx")) | (F.col("ty") != F.col("new_ty")))


def rings(points: DataFrame, cx: Column, cy: Column, width: float = 0.2, last: float = 12.0) -> DataFrame:
    """(ring, n, density): points by distance from a centre, per area."""
    r = F.sqrt((F.col("x") - cx) ** 2 + (F.col("y") - cy) ** 2)
    k = points.select(F.floor(r / width).cast("long").alias("ring")).where(F.col("ring") < int(round(last / width)))
    area = F.pi() * width * width * (F.pow(F.col("ring") + 1, 2) - F.pow("ring", 2))
    return k.groupBy("ring").agg(F.count("*").alias("n")).withColumn("density", F.col("n") / area)


def core_radius(profile: DataFrame, width: float = 0.2, part: float = 0.3) -> DataFrame:
    """One row: where the density first reaches a part of its peak."""
    peak = profile.agg(F.max("density").alias("peak"))
    return profile.crossJoin(F.broadcast(peak)).where(F.col("density") >= F.col("peak") * part).agg((F.min("ring") * width).alias("radius"))  # peak: one row


def nearest_in_plane(queries: DataFrame, points: DataFrame, k: int, cell: float, reach: int = 1) -> DataFrame:
    """(src, dst, dist, rank): for queries (id, x, y), the k nearest points among the cells around their own. A result
    is exact where the k-th distance is at most ``reach`` cells; ``exact`` says so, and the caller may widen the reach
    for the rest."""
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    p = points.select(F.col("id").alias("dst"), F.col("x").alias("px"), F.col("y").alias("py"), at("x").alias("cx"), at("y").alias("cy"))
    around = F.expr(f"explode(flatten(transform(sequence(-{reach}, {reach}), i -> transform(sequence(-{reach}, {reach}), j -> struct(i, j)))))")
    q = queries.select(F.col("id").alias("src"), "x", "y", at("x").alias("ox"), at("y").alias("oy")).withColumn("o", around)
    q = q.select("src", "x", "y", (F.col("ox") + F.col("o")["i"]).alias("cx"), (F.col("oy") + F.col("o")["j"]).alias("cy"))
    d = q.join(p, ["cx", "cy"]).where("src <> dst").withColumn("dist", F.round(F.sqrt((F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2), 6))
    return top_per(d, ["src"], k, F.col("dist"), F.col("dst")).select("src", "dst", "dist", F.col("rank").cast("long").alias("rank"), (F.col("dist") <= reach * cell).alias("exact"))


def k_nearest(queries: DataFrame, points: DataFrame, k: int, cell: float, most: int = 16) -> DataFrame:
    """As nearest_in_plane, widened for queries whose k-th neighbour may lie beyond the cells looked at. Queries that
    ``most`` cells in every direction can't answer (far points, or fewer than k others) are compared with all points,
    so every answer is exact however the points lie."""
    from lumbrera.plans.lineage import cut

    out, left, reach = None, queries, 1
    total = points.count()
    while reach <= most:
        got = cut(nearest_in_plane(left, points, k, cell, reach), "plane")
        sure = got.groupBy("src").agg(F.count("*").alias("n"), F.min(F.col("exact").cast("int")).alias("e")).where((F.col("e") == 1) & (F.col("n") >= min(k, total - 1)))
        done = got.join(sure.select("src"), "src", "left_semi").drop("exact")
        out = done if out is None else out.unionByName(done)
        left = left.join(sure.select(F.col("src").alias("id")), "id", "left_anti")
        if not left.limit(1).count():
            return out
        reach *= 4
    return out.unionByName(_by_all(cut(left.select("id", "x", "y"), "plane-left"), points, k))


def _by_all(queries: DataFrame, points: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """(src, dst, dist, rank) of queries compared with all points, in blocks of queries of bounded size, a pass each."""
    spark = points.sparkSession
    rounds = max(1, -(-queries.count() // block))
    out = None
    for r in range(rounds):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r).toPandas()
        shared = spark.sparkContext.broadcast((part["id"].to_numpy(), part[["x", "y"]].to_numpy(float)))

        def nearest(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            for pdf in batches:
                own, p = pdf["id"].to_numpy(), pdf[["x", "y"]].to_numpy(float)
                for lo in range(0, len(own) if len(ids) else 0, 2048):
                    d = np.sqrt(((q[:, None] - p[None, lo : lo + 2048]) ** 2).sum(axis=2)).round(6)
                    d[ids[:, None] == own[None, lo : lo + 2048]] = np.inf
                    last = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
                    i, j = np.nonzero((d <= last[:, None]) & np.isfinite(d))
                    yield pd.DataFrame({"src": ids[i], "dst": own[lo + j], "dist": d[i, j]})

        kind = queries.schema["id"].dataType.simpleString(), points.schema["id"].dataType.simpleString()
        found = points.select("id", "x", "y").mapInPandas(nearest, f"src {kind[0]}, dst {kind[1]}, dist double")
        out = found if out is None else out.unionByName(found)
    return top_per(out, ["src"], k, F.col("dist"), F.col("dst")).select("src", "dst", "dist", F.col("rank").cast("long").alias("rank"))


def confusion(voted: DataFrame, truth: str, guess: str) -> DataFrame:
    """One row: accuracy of a vote and of always guessing the commonest class."""
    n = voted.agg(F.count("*").alias("n"), F.avg((F.col(truth) == F.col(guess)).cast("int")).alias("accuracy"))
    top = voted.groupBy(truth).agg(F.count("*").alias("c")).agg(F.max("c").alias("c"))
    return n.crossJoin(F.broadcast(top)).select(F.round("accuracy", 4).alias("accuracy"), F.round(F.col("c") / F.col("n"), 4).alias("baseline"))  # one row each


def largest_hole(points: DataFrame, bins: int = 200, dilate: int = 5) -> list[tuple[int, int]]:
    """Cells of the largest empty region enclosed by points, grown by ``dilate`` cells. The histogram, of bins x bins
    cells at most, is counted by Spark; the flood fill over it runs on the driver."""
    cells = tiles(points, bins).select("tx", "ty").distinct().collect()
    full = np.zeros((bins, bins), bool)
    for r in cells:
        full[r["tx"], r["ty"]] = True
    outside = np.zeros_like(full)
    queue = deque((i, j) for i in range(bins) for j in range(bins) if (i in (0, bins - 1) or j in (0, bins - 1)) and not full[i, j])
    for c in queue:
        outside[c] = True

    def around(c):
        i, j = c
        return [(a, b) for a, b in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)) if 0 <= a < bins and 0 <= b < bins]

    while queue:
        for n in around(queue.popleft()):
            if not full[n] and not outside[n]:
                outside[n] = True
                queue.append(n)
    holes, seen = [], full | outside
    for i in range(bins):
        for j in range(bins):
            if not seen[i, j]:
                seen[i, j] = True
                part, queue = [(i, j)], deque([(i, j)])
                while queue:
                    for n in around(queue.popleft()):
                        if not seen[n]:
                            seen[n] = True
                            part.append(n)
                            queue.append(n)
                holes.append(part)
    best = set(max(holes, key=len)) if holes else set()
    for _ in range(dilate if best else 0):
        best |= {n for c in best for n in around(c)}
    return sorted(best)


def palette(n: int) -> list[str]:
    """n colours, evenly spaced by the golden ratio around the hue circle, as #rrggbb."""
    import colorsys

    return ["#%02x%02x%02x" % tuple(round(v * 255) for v in colorsys.hsv_to_rgb(i * 0.618033988749895 % 1, 0.55 + 0.15 * (i % 3) / 2, 0.9 - 0.15 * (i % 2))) for i in range(n)]
