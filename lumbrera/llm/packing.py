"""Filling fixed-capacity containers: a configuration linear program over the histogram of lengths.

Columns of the program are configurations (how many items of each length share one container). Multiplicative weights
solve its covering form: each round prices lengths by how little they are covered, a knapsack dynamic program finds
the configuration worth most, and that configuration enters the solution. The fractional solution is rounded down to
whole containers, and what is left over, at most the items of one container per configuration, is placed from the
longest item down, each time with the longest that still fits. The prices of every round, divided by what the best
configuration is worth at them, are a solution of the dual program: the best of them bounds from below how few
containers any packing can have. The histogram has at most ``capacity`` lengths whatever the number of items, so the driver's work and the
plan it broadcasts are bounded; items themselves never leave the executors.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rounds of multiplicative weights at most, and salts over which equal lengths are numbered.
ROUNDS = 700
SALTS = 64
#: Configurations that one knapsack gives, and how fast a covered length loses weight.
COLUMNS, ETA = 48, 0.7


@dataclass
class Plan:
    """configs: (times, {length: items a container}) in the order in which containers are numbered."""

    configs: list[tuple[int, dict[int, int]]]
    bound: float  # no packing has fewer containers: the larger of the volume and the best dual solution
    by: str = "program"  # or "greedy", should the completion of an empty solution take fewer containers

    @property
    def containers(self) -> int:
        return sum(t for t, _ in self.configs)


def best_fills(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over lengths (ascending): for every room up to the capacity, the greatest value that fits,
    and the index of a length that begins such a filling (-1: leave a unit empty)."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        if k := ends[w]:
            gain = best[w - lengths[:k]] + values[:k]
            j = int(np.argmax(gain))
            if gain[j] > best[w] + 1e-15:
                best[w], take[w] = gain[j], j
    return best, take


def filling(take: np.ndarray, lengths: np.ndarray, room: int) -> Counter:
    """The lengths (by index) of the best filling of a room."""
    out: Counter = Counter()
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            out[int(take[room])] += 1
            room -= int(lengths[take[room]])
    return out


def price(values: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of greatest value, clipped to counts."""
    return {k: min(n, int(counts[k])) for k, n in filling(best_fills(values, lengths, capacity)[1], lengths, capacity).items()}


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, columns: int = COLUMNS, eta: float = ETA) -> tuple[list[tuple[float, dict[int, int]]], float]:
    """(solution, dual bound). Multiplicative weights for the covering program: every length's count covered by configurations, as few as can be.

    A length's weight falls exponentially with the part of it that is covered; its price is its weight times its
    length (at an even covering the optimal dual is the length itself). One knapsack a round prices all rooms; the
    lengths with most left to cover each begin a configuration that the knapsack completes, and it enters the solution
    with half of what its scarcest length has left, all of it once little is left."""
    left = counts.astype(float).copy()
    used: dict[tuple, float] = {}
    dual = float(np.dot(lengths, counts)) / capacity
    for r in range(rounds):
        open_ = left > 1e-6
        if not open_.any():
            break
        weight = np.exp(-eta * (1 - left / counts)) * open_
        worth, take = best_fills(weight * lengths, lengths, capacity)
        dual = max(dual, float(np.dot(counts, weight * lengths)) / worth[capacity])
        share, fresh = 0.5 if r < rounds // 2 else 1.0, False
        for k in np.argsort(-left * lengths, kind="stable")[:columns]:
            if left[k] <= 1e-6:
                continue
            config = filling(take, lengths, capacity - int(lengths[k]))
            config[int(k)] += 1
            gone = [j for j in config if left[j] <= 1e-6]
            if gone and fresh:
                continue  # the knapsack's filling is used up: the next round finds another
            fresh = True
            for j in gone:
                del config[j]
            scarce = min(left[j] / a for j, a in config.items())
            amount = scarce if scarce < 1 else scarce * share
            key = tuple(sorted(config.items()))
            used[key] = used.get(key, 0.0) + amount
            for j, a in config.items():
                left[j] = max(0.0, left[j] - a * amount)
    return [(x, dict(key)) for key, x in used.items()], dual


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> Plan:
    """Whole containers for all items of a histogram {length: items}, 0 < length <= capacity: the program's solution
    rounded down and completed, or what completes an empty solution should that take fewer containers."""
    if not histogram:
        return Plan([], 0.0)
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths], dtype=float)
    solution, bound = fractional(lengths, counts, capacity, rounds)
    program = Plan(_whole(lengths, counts, solution, capacity), bound)
    greedy = Plan(_whole(lengths, counts, [], capacity), bound, "greedy")
    return program if program.containers <= greedy.containers else greedy


def _whole(lengths: np.ndarray, counts: np.ndarray, solution: list[tuple[float, dict[int, int]]], capacity: int) -> list[tuple[int, dict[int, int]]]:
    left = counts.astype(np.int64)
    configs: list[tuple[int, dict[int, int]]] = []
    for x, c in sorted(solution, key=lambda p: (-sum(int(lengths[k]) * a for k, a in p[1].items()), sorted(p[1].items()))):
        if capacity - sum(int(lengths[k]) * a for k, a in c.items()) > capacity // 64:
            continue  # a loose configuration is worth less than best fit over what is left
        times = min([int(np.floor(x + 1e-9)), *(int(left[k]) // a for k, a in c.items())])
        if times > 0:
            configs.append((times, {int(lengths[k]): a for k, a in c.items()}))
            for k, a in c.items():
                left[k] -= times * a
    # The rest: containers filled from the longest item down, each time with the longest that still fits; containers
    # of one content are emitted together while the histogram allows it, so the work follows the lengths, not the items.
    rest = {int(lengths[k]): int(n) for k, n in enumerate(left) if n}
    order = sorted(rest, reverse=True)
    while order:
        room, content = capacity, Counter()
        for x in order:
            if x <= room:
                a = min(room // x, rest[x])
                content[x] += a
                room -= a * x
        times = min(rest[x] // a for x, a in content.items())
        configs.append((times, dict(content)))
        for x, a in content.items():
            rest[x] -= times * a
        order = [x for x in order if rest[x]]
    return configs


def pack(items: DataFrame, size: str, keys: list[str], capacity: int = 2048, rounds: int = ROUNDS, salts: int = SALTS) -> DataFrame:
    """One row for each piece of each item: keys, n_tokens (the item's size), piece (from 0), length, container (from
    0), slot (from 0 in its container) and start (its first unit there).

    Items longer than ``capacity`` become full pieces and one rest; no other item is split. Items of size 0 or null
    take no room: they come out once with null container, slot and start. Equal rows count as separate items. Other
    columns are dropped, so names can't clash.
    """
    spark = items.sparkSession
    cap = F.lit(capacity)
    n = F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0))
    base = items.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("k"), F.greatest(n, F.lit(0)).alias("n"))
    pieces = base.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / cap) - 1, F.lit(0)))))
    pieces = pieces.withColumn("length", F.least(cap.cast("long"), F.col("n") - F.col("piece") * cap).cast("int"))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("k", "piece"), F.lit(salts)).cast("int"))
    per_salt = pieces.where("length > 0").groupBy("length", "salt").agg(F.count("*").alias("c"))
    table = per_salt.toPandas()  # at most capacity x salts rows
    hist = table.groupby("length")["c"].sum().to_dict() if len(table) else {}
    made = plan({int(k): int(v) for k, v in hist.items()}, capacity, rounds)

    offsets = {}
    for length, g in table.sort_values(["length", "salt"]).groupby("length"):
        run = 0
        for salt, c in zip(g["salt"], g["c"], strict=True):
            offsets[int(length), int(salt)] = run
            run += int(c)
    # For each length, runs of its ranks: (first rank, first container, items a container, first slot, first unit).
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
    done: Counter = Counter()
    container = 0
    for times, content in made.configs:
        slot = start = 0
        for length in sorted(content, reverse=True):
            a = content[length]
            runs.setdefault(length, []).append((done[length], container, a, slot, start))
            done[length] += times * a
            slot, start = slot + a, start + a * length
        container += times
    packed = {k: np.array(v, dtype=np.int64) for k, v in runs.items()}
    shared = spark.sparkContext.broadcast((offsets, packed))  # bounded by capacity x salts and by rounds x lengths

    @F.pandas_udf("container long, slot int, start int")
    def place(length: pd.Series, salt: pd.Series, rank: pd.Series) -> pd.DataFrame:
        offs, table_ = shared.value
        out = np.zeros((len(length), 3), dtype=np.int64)
        lengths, salts_, ranks = length.to_numpy(), salt.to_numpy(), rank.to_numpy()
        for x in np.unique(lengths):
            rows = np.nonzero(lengths == x)[0]
            r = ranks[rows] - 1 + np.array([offs[int(x), int(s)] for s in salts_[rows]], dtype=np.int64)
            t = table_[int(x)]
            e = t[np.searchsorted(t[:, 0], r, side="right") - 1]
            at = r - e[:, 0]
            out[rows, 0] = e[:, 1] + at // e[:, 2]
            out[rows, 1] = e[:, 3] + at % e[:, 2]
            out[rows, 2] = e[:, 4] + (at % e[:, 2]) * x
        return pd.DataFrame({"container": out[:, 0], "slot": out[:, 1].astype("int32"), "start": out[:, 2].astype("int32")})

    w = Window.partitionBy("length", "salt").orderBy("k", "piece")
    placed = pieces.where("length > 0").withColumn("rank", F.row_number().over(w)).withColumn("p", place("length", "salt", "rank"))
    none = pieces.where("length <= 0").withColumn("p", F.lit(None).cast("struct<container:bigint,slot:int,start:int>"))
    cols = [F.col("k")[k].alias(k) for k in keys] + [F.col("n").alias("n_tokens"), F.col("piece").cast("int").alias("piece"), "length", "p.container", "p.slot", "p.start"]
    return placed.select(*cols).unionByName(none.select(*cols))
