"""The k most similar vectors of every vector, by shifted space-filling curves.

Each of several curves projects all vectors onto a few random directions of its own, shifts and quantises them, and
orders them by their Hilbert key. Spark range-partitions each order and numbers it; ranges of equal length take a halo
of rows from either side, so that every vector is compared with all others within REACH places of it, in blocked
matrix products. The windows of all curves are merged and ranked by exact cosine. Only (curve, key, id) travels
through the sort; vectors follow once, to their ranges.

How many curves met each of the k best partners tells how likely one was missed by all of them (what is met again and
again is complete, what was met once has siblings unseen). Where a floor of similarity keeps unlike vectors apart, the
links found make components, and all vectors of one are compared with each other; for very great ones, and where there
is no such floor, only vectors whose partners were met by few curves are asked again: they are compared with all vectors
(of such components), in blocks of bounded size and in single precision with a proven margin, but for blocks whose angles
say that none of the best can be there. Exact copies are folded beforehand and expanded afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.vectors import Sections, angles, directions, first_ids, fold, led, matrix, sent, slack, unit, usable
from lumbrera.operators.graph import components
from lumbrera.plans.lineage import cut, drop, spread, width

#: Curves, directions and bits of each, rows compared at once, rows to either side of them, rows of a range.
CURVES, DIMS, BITS, BLOCK, REACH, RANGE = 8, 6, 10, 512, 1024, 16384
#: Curves that must have met a vector's partners, on the mean, for its list to be taken as complete.
MET = 3.0
#: Cosine from which links join alike vectors, not all of a table; vectors of a component that are compared in one task.
CHAINED, WHOLE = 0.5, 16384


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer points (rows) along the Hilbert curve; dims x bits must be below 64."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_key(u: np.ndarray, curve: int, dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of unit vectors on one of the curves."""
    p = u @ directions(u.shape[1], dims, 1000 + curve)
    shift = np.random.default_rng(curve).uniform(-0.125, 0.125, p.shape[1])
    cells = np.clip((p * 0.5 + 0.5 + shift) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    return hilbert(cells, bits)


def _best(own: np.ndarray, q: np.ndarray, phi: np.ndarray, least: np.ndarray, parts: Sections, k: int, floor: float):
    """(row, id, cosine) of the k most similar for unit vectors ``q`` at the angles ``phi`` to their nearest leaders, by
    row, cosine and id, those below ``least`` left out. Sections are met in their order."""
    gap, ids, x = slack(q.shape[1]), parts.ids, parts.x
    q32 = q.astype(np.float32)
    open_ = parts.open(q32, phi, angles(least))
    at, to, sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.maximum(least, floor) - 1e-9
    for section in np.nonzero(open_.any(axis=0))[0]:
        lo, hi = parts.bounds[section]
        some = np.nonzero(open_[:, section])[0]
        s = q32[some] @ parts.single(section).T
        hit = s >= (least[some] - gap).astype(np.float32)[:, None]
        if hi - lo > k + 1 and np.count_nonzero(hit) > 4 * k * len(some):  # the k + 1 best of the section, the row itself being one
            top = np.partition(s, hi - lo - k - 1, axis=1)[:, hi - lo - k - 1].astype(np.float64)
            hit = s >= (np.maximum(least[some], top - gap) - gap).astype(np.float32)[:, None]
        r, c = np.nonzero(hit)
        r, c = some[r], c + lo
        other = ids[c] != own[r]
        r, c = r[other], c[other]
        if not len(r):
            continue
        e = np.concatenate([np.einsum("id,id->i", unit(x[c[i : i + 65536]]), q[r[i : i + 65536]]) for i in range(0, len(r), 65536)]).round(9)
        good = e >= floor
        at, to, sim = np.concatenate([at, r[good]]), np.concatenate([to, ids[c[good]]]), np.concatenate([sim, e[good]])
        order = np.lexsort((to, -sim, at))
        at, to, sim = at[order], to[order], sim[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        last = place == k - 1
        least[at[last]] = np.maximum(least[at[last]], sim[last] - 1e-9)
        at, to, sim = at[place < k], to[place < k], sim[place < k]
    return at, to, sim


def _window(ids: np.ndarray, rows: np.ndarray, q: slice, w: slice, k: int, floor: float):
    """(row, id, cosine) of the up to k most similar among rows ``w`` for each of rows ``q``, the row itself left out."""
    a, b, lo, hi = q.start, q.stop, w.start, w.stop
    s = rows[a:b].astype(np.float32) @ rows[lo:hi].astype(np.float32).T
    s[np.arange(b - a), np.arange(a - lo, b - lo)] = -2
    least = np.float32(max(floor, -1.5) - slack(rows.shape[1]) - 1e-6)
    open_ = np.nonzero(s.max(axis=1) >= least)[0]
    if not len(open_):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    s = s if len(open_) == b - a else s[open_]
    if s.shape[1] > k + 2:  # two more than asked, since single precision may order near ties otherwise
        least = np.maximum(np.partition(s, s.shape[1] - k - 2, axis=1)[:, s.shape[1] - k - 2], least)[:, None]
    r, c = np.divmod(np.flatnonzero(s >= least), s.shape[1])
    e = np.concatenate([np.einsum("id,id->i", rows[a + open_[r[i : i + 65536]]], rows[lo + c[i : i + 65536]]) for i in range(0, len(r), 65536)]).round(9)
    good = e >= floor
    r, c, e = open_[r[good]], ids[lo + c[good]], e[good]
    order = np.lexsort((c, -e, r))
    r, c, e = r[order], c[order], e[order]
    first = (np.arange(len(r)) - np.searchsorted(r, r)) < k
    return r[first], c[first], e[first]


def numbered(distinct: DataFrame, curves: int, length: int) -> tuple[DataFrame, int]:
    """((curve, id, rank), rows of all orders): places along the curves, one curve after the other. Ranks are taken per
    partition of the range-partitioned order, whose sizes, one number a partition, give the offsets."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                u = unit(matrix(pdf["vec"]))
                for c in range(curves):
                    yield pd.DataFrame({"curve": np.int32(c), "key": curve_key(u, c), "id": pdf["id"]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        pid, at = TaskContext.get().partitionId(), 0
        for pdf in batches:
            yield pdf.assign(pid=np.int32(pid), place=np.arange(at, at + len(pdf)))
            at += len(pdf)

    parts = max(width(distinct.sparkSession, 1), -(-distinct.count() * curves // (length * 8)))
    keys = spread(distinct.select("id", "vec")).mapInPandas(keyed, "curve int, key long, id long")
    ordered = keys.repartitionByRange(parts, "curve", "key", "id").sortWithinPartitions("curve", "key", "id").select("curve", "id")
    placed = cut(ordered.mapInPandas(count, "curve int, id long, pid int, place long"), "placed")
    sizes = {r["pid"]: r["n"] for r in placed.groupBy("pid").agg(F.count("*").alias("n")).collect()}  # a row a partition
    offsets, total = [], 0
    for pid in sorted(sizes):
        offsets.append((pid, total))
        total += sizes[pid]
    starts = distinct.sparkSession.createDataFrame(offsets, "pid int, first long")
    return placed.join(F.broadcast(starts), "pid").select("curve", "id", (F.col("first") + F.col("place")).alias("rank")), total


def window_neighbours(distinct: DataFrame, k: int, floor: float, curves: int = CURVES, block: int = BLOCK, reach: int = REACH, length: int = RANGE) -> DataFrame:
    """(id, a array<struct<s, nb>>, met): for distinct vectors, the k best partners over all curves with cosine >=
    floor, s being the negative cosine, and on how many curves they were met on the mean."""
    spark = distinct.sparkSession
    length = max(length, 2 * reach)
    ranked, total = numbered(distinct, curves, length)
    at, last = F.expr(f"rank div {length}"), F.col("rank") % length
    own = F.array(F.struct(at.alias("range"), F.lit(True).alias("own")))
    before = F.when(last < reach, F.array(F.struct((at - 1).alias("range"), F.lit(False).alias("own")))).otherwise(F.array())
    after = F.when(last >= length - reach, F.array(F.struct((at + 1).alias("range"), F.lit(False).alias("own")))).otherwise(F.array())
    placed = ranked.select("curve", "id", "rank", F.explode(F.concat(own, before, after)).alias("p")).select("curve", "id", "rank", "p.range", "p.own")
    ranges = max(1, -(-total // length))
    wide = placed.join(distinct.select("id", "vec"), "id").repartition(min(ranges, 20000), "range").sortWithinPartitions("range", "rank")

    def work(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(parts) if len(parts) > 1 else parts[0]
        ids, curve, mine = pdf["id"].to_numpy(), pdf["curve"].to_numpy(), np.nonzero(pdf["own"].to_numpy())[0]
        rows = unit(matrix(pdf["vec"]))
        out = []
        for lo in range(int(mine[0]), int(mine[-1]) + 1, block) if len(mine) else ():
            hi = min(lo + block, int(mine[-1]) + 1)
            for c in np.unique(curve[lo:hi]):  # ranks are consecutive, so are the rows of a curve
                a, b = np.searchsorted(curve, c), np.searchsorted(curve, c, "right")
                q = slice(max(lo, int(a)), min(hi, int(b)))
                r, nb, sim = _window(ids, rows, q, slice(max(int(a), q.start - reach), min(int(b), q.stop + reach)), k, floor)
                out.append((ids[q.start + r], nb, sim))
        if out:
            yield pd.DataFrame({"id": np.concatenate([x[0] for x in out]), "nb": np.concatenate([x[1] for x in out]), "sim": np.concatenate([x[2] for x in out])})

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the rows of one range, at most length + 2 x reach
        for pdf in batches:
            for r, part in pdf.groupby("range", sort=True):
                if held and held[0]["range"].iloc[0] != r:
                    yield from work(held)
                    held = []
                held.append(part)
        if held:
            yield from work(held)

    met = wide.mapInPandas(windows, "id long, nb long, sim double").groupBy("id", "nb").agg(F.max("sim").alias("sim"), F.count("*").alias("curves"))
    listed = met.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("s"), "nb", "curves"))), 1, k).alias("a"))
    mean = F.aggregate("a", F.lit(0).cast("long"), lambda x, p: x + p["curves"]) / F.size("a")
    return listed.select("id", F.transform("a", lambda p: F.struct(p["s"].alias("s"), p["nb"].alias("nb"))).alias("a"), mean.alias("met"))


def leaders_of(asked: DataFrame, some: int = 4096, within: float = 0.82) -> np.ndarray:
    """Unit vectors of some of ``asked``, no two nearer than the cosine ``within``: where sections are centred."""
    rest = unit(matrix(r["vec"] for r in asked.orderBy(F.xxhash64("id"), "id").limit(some).select("vec").collect()))
    out = []
    while len(rest):
        out.append(rest[0])
        rest = rest[rest @ rest[0] < within]
    return np.array(out)


def exact_neighbours(asked: DataFrame, distinct: DataFrame, k: int, floor: float, block: int = 1024) -> DataFrame:
    """(id, a array<struct<s, nb>>): the k best partners of each vector of ``asked`` among all distinct vectors, which
    are sent to the tasks in parts of bounded size, a pass each. ``asked`` (id, and least if it is known) are some of
    them; a partner below ``least``, the cosine of the k-th of k known ones, is none of the k best. Sections whose angles
    to their leader rule out such partners are passed over."""
    if "least" not in asked.columns:
        asked = asked.select("id", F.lit(floor).cast("double").alias("least"))
    asked, out = cut(asked.select("id", "least"), "asked"), None
    leaders = leaders_of(asked.join(distinct.select("id", "vec"), "id"))
    if not len(leaders):
        return distinct.sparkSession.createDataFrame([], "id long, a array<struct<s: double, nb: long>>")
    placed = cut(led(distinct.select("id", "vec"), leaders), "led")
    rows_of = spread(placed.join(asked, "id").select("id", "vec", "cell", "phi", "least"), 4)
    for shared in sent(placed, leaders):

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            def work(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                pdf = pd.concat(held).sort_values(["cell", "phi"], kind="stable")
                for lo in range(0, len(pdf), block):
                    some = pdf.iloc[lo : lo + block]
                    own = some["id"].to_numpy()
                    at, to, sim = _best(own, unit(matrix(some["vec"])), some["phi"].to_numpy(), some["least"].to_numpy(), shared.value, k, floor)
                    if len(at):
                        yield pd.DataFrame({"id": own[at], "nb": to, "sim": sim})

            held: list[pd.DataFrame] = []  # rows of a cell together meet its sections once
            for pdf in batches:
                held.append(pdf)
                if sum(map(len, held)) >= 65536:
                    yield from work(held)
                    held = []
            if held:
                yield from work(held)

        found = cut(rows_of.mapInPandas(search, "id long, nb long, sim double"), "nearest")
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("s"), "nb"))), 1, k).alias("a"))


def component_neighbours(members: DataFrame, k: int, floor: float, block: int = BLOCK) -> DataFrame:
    """(id, nb, sim): for vectors (id, vec, label), the k best partners of each among those of its label, by comparing
    all of them. A label has at most WHOLE vectors, which a task holds at once."""

    def work(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(held) if len(held) > 1 else held[0]
        label, ids = pdf["label"].to_numpy(), pdf["id"].to_numpy()
        rows, out = unit(matrix(pdf["vec"])), []
        edges = [0, *(np.nonzero(label[1:] != label[:-1])[0] + 1).tolist(), len(label)]
        for s, e in zip(edges, edges[1:]):
            for lo in range(s, e, block):
                r, nb, sim = _window(ids, rows, slice(lo, min(lo + block, e)), slice(s, e), k, floor)
                out.append((ids[lo + r], nb, sim))
        yield pd.DataFrame({"id": np.concatenate([x[0] for x in out]), "nb": np.concatenate([x[1] for x in out]), "sim": np.concatenate([x[2] for x in out])})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows come sorted by label: the last label of a batch waits for the next batch
        for pdf in batches:
            if not len(pdf):
                continue
            last = pdf["label"].iloc[-1]
            done, rest = pdf[pdf["label"] != last], pdf[pdf["label"] == last]
            if len(done):
                yield from work([*held, done])
                held = []
            elif held and held[-1]["label"].iloc[-1] != last:
                yield from work(held)
                held = []
            held.append(rest)
        if held:
            yield from work(held)

    parts = max(width(members.sparkSession), -(-members.count() // (2 * WHOLE)))
    return members.repartition(parts, "label").sortWithinPartitions("label", "id").mapInPandas(search, "id long, nb long, sim double")


def rep_neighbours(distinct: DataFrame, k: int, floor: float, curves: int = CURVES, block: int = BLOCK, reach: int = REACH, met: float = MET, length: int = RANGE) -> DataFrame:
    """(id, nb, sim): for distinct vectors, the k best partners with cosine >= floor.

    Links of at least CHAINED join alike vectors, so partners are sought within the components that the windows' links
    make. Windows thin out as a table grows; so vectors that no window has linked, and the first of each component, go
    through windows of their own, and what they link is joined. Components of up to WHOLE vectors are compared whole;
    in greater ones, doubtful vectors are compared with all of these."""
    near = cut(window_neighbours(distinct, k, floor, curves, block, reach, length), "windows")
    flat = lambda d: d.select("id", F.explode("a").alias("p")).select("id", F.col("p.nb").alias("nb"), (-F.col("p.s")).alias("sim"))
    links = lambda d: flat(d).select(F.col("id").alias("a"), F.col("nb").alias("b"))
    whole = None
    if floor >= CHAINED and 0 < met <= curves:
        label = components(links(near))
        first = cut(distinct.select("id", "vec").join(label.where("id <> label"), "id", "left_anti"), "first-vectors")
        moved = components(links(window_neighbours(first, k, floor, curves, block, reach, length))).select(F.col("id").alias("label"), F.col("label").alias("to"))
        drop(first)
        alone = moved.select(F.col("label").alias("id"), "label").join(label, "id", "left_anti")
        label = cut(label.unionByName(alone).join(moved, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "components")
        sized = cut(label.join(label.groupBy("label").agg(F.count("*").alias("n")), "label"), "sized-components")
        whole = cut(component_neighbours(distinct.select("id", "vec").join(sized.where(F.col("n") <= WHOLE).select("id", "label"), "id"), k, floor, block), "within-components")
        great = sized.where(F.col("n") > WHOLE).select("id")
        near = great.join(near, "id", "left").select("id", "a", F.coalesce("met", F.lit(0.0)).alias("met"))
        distinct = distinct.join(great, "id", "left_semi")
    last = F.when(F.size("a") >= k, -F.element_at("a", -1)["s"])
    doubtful = near.where(F.col("met") < met).select("id", F.coalesce(last, F.lit(floor)).cast("double").alias("least"))
    if doubtful.limit(1).count():
        again = cut(exact_neighbours(doubtful, distinct, k, floor), "asked-again")
        near = near.where(F.col("met") >= met).select("id", "a").unionByName(again)
    return flat(near) if whole is None else flat(near).unionByName(whole)


def recall(df: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 5, floor: float = 0.8, every: int = 20, **options) -> DataFrame:
    """(asked, wanted, found, recall): how many of the k best partners most_similar() finds, held against a comparison
    with all vectors, for the vectors whose id is divisible by ``every``."""
    distinct, _ = fold(usable(df, key, column))
    asked = distinct.where(F.col("id") % every == 0)
    pairs_of = lambda d: d.select("id", F.explode("a").alias("p")).select("id", F.col("p.nb").alias("nb"))
    want = cut(pairs_of(exact_neighbours(asked, distinct, k, floor)), "wanted")
    got = rep_neighbours(distinct, k, floor, **options).select("id", "nb", F.lit(1).alias("hit"))
    n = asked.agg(F.count("*").alias("asked"))
    held = want.join(got, ["id", "nb"], "left").agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))
    return n.join(held).withColumn("recall", F.when(F.col("wanted") > 0, F.round(F.col("found") / F.col("wanted"), 6)))


def most_similar(df: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 5, floor: float = -1.0, curves: int = CURVES, block: int = BLOCK, reach: int = REACH, met: float = MET) -> DataFrame:
    """(id, nb, sim, rank): the k vectors of the table most similar to each, cosine rounded to 9 decimals.

    Ties go to the smaller id, the vector itself is left out, copies of it count. ``floor`` keeps partners of at
    least that cosine. Vectors without a direction (null, empty, all-zero, not finite) neither ask nor answer. An
    empty table gives no rows. Other columns are dropped. Vectors whose partners were met by fewer than ``met`` curves
    are compared with all others, or with those of their component from a floor of CHAINED on (rep_neighbours): 0 keeps
    to the windows, more than ``curves`` compares every vector that has partners with all others. What no window of any
    curve met at all isn't asked again, but for the second windows of such a floor.
    """
    distinct, members = fold(usable(df, key, column))
    near = cut(rep_neighbours(distinct, k + 1, floor, curves, block, reach, met), "neighbours")
    some = cut(first_ids(members, k + 1), "first-copies")
    own = distinct.where("copies > 1").select("id", F.col("id").alias("nb"), F.lit(1.0).alias("sim"))
    options = near.unionByName(own).join(some.select(F.col("rep").alias("nb"), F.col("id").alias("m")), "nb")
    listed = options.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("s"), "m"))), 1, k + 1).alias("a"))
    each = members.join(listed.withColumnRenamed("id", "rep"), "rep").select("id", F.expr(f"slice(filter(a, x -> x.m <> id), 1, {k})").alias("a"))
    return each.select("id", F.posexplode("a").alias("rank", "p")).select("id", F.col("p.m").alias("nb"), (-F.col("p.s")).alias("sim"), (F.col("rank") + 1).alias("rank"))


def pairs(near: DataFrame) -> DataFrame:
    """Each pair once, the smaller id first."""
    return near.select(F.least("id", "nb").alias("vec_a"), F.greatest("id", "nb").alias("vec_b")).distinct()
