"""Relational operators that go beyond one DataFrame method."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.functions import text as X
from lumbrera.plans.lineage import cut


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Allow-listed projection with new names; a listed column that is missing is an error."""
    lost = [c for c in names if c not in df.columns]
    if lost:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])


def available(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of the requested columns that there are, in the order requested."""
    return df.select(*[F.col(f"`{c}`") for c in names if c in df.columns])


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Columns of ``schema`` in its order: missing ones are added (empty string, 0, false, null double), others
    forced to their type without failing on values that can't be cast."""
    fill = {"string": F.lit(""), "bigint": F.lit(0).cast("long"), "boolean": F.lit(False), "double": F.lit(None).cast("double")}

    def one(name: str, kind: str) -> Column:
        if name not in df.columns:
            return fill[kind].alias(name)
        c = F.col(f"`{name}`")
        if kind == "string":
            return F.coalesce(c.cast("string"), F.lit("")).alias(name)
        if kind == "boolean":
            return X.boolean(c).alias(name)
        return F.coalesce(c.try_cast(kind), fill[kind]).alias(name)

    return df.select(*[one(*x) for x in schema.items()])


def richest(columns: Sequence[str], sep: str = r"\|") -> Column:
    """struct(value, source): of several columns the one with most names, then most separators, then the longest
    value, then the first."""
    options = []
    for k, c in enumerate(columns):
        v = X.clean(F.col(c))
        options.append(F.struct(F.size(X.split_list(v, sep)).alias("names"), (F.size(F.split(v, sep)) - 1).alias("seps"), F.length(v).alias("len"), F.lit(-k).alias("pos"), v.alias("value"), F.lit(c).alias("source")))
    best = F.array_max(F.array(*options))
    return F.struct(best["value"].alias("value"), best["source"].alias("source"))


def one_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """A join that fails if either side repeats a key (nulls left out)."""
    for side, df in (("left", left), ("right", right)):
        if df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError(f"the {side} side repeats values of {key}")
    return left.join(right, key, how)


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row a key, the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_per(df: DataFrame, keys: Sequence[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first n rows a key with their rank; the limit is applied before rows are exchanged."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def share_dominant(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, dominant, share): the commonest non-null value of each group (ties: the smallest) and its part."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    return counts.groupBy(*keys).agg(F.sum("c").alias("n"), F.min_by(value, F.struct(-F.col("c"), F.col(value))).alias("dominant"), F.max("c").alias("m")).select(*keys, "n", "dominant", (F.col("m") / F.col("n")).alias("share"))


def majority(df: DataFrame, key: str, value: str, threshold: float) -> DataFrame:
    """(key, n, canonical, share, decided): the value that a group should have, decided where its share reaches the
    threshold, else left for a report."""
    return share_dominant(df, [key], value).select(key, "n", F.col("dominant").alias("canonical"), "share", (F.col("share") >= threshold).alias("decided"))


def top_string(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """(key, top): ``value (count)`` of the n commonest values of each group, joined by ``|``."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("c"))
    ranked = top_per(counts, [key], n, F.desc("c"), F.col(value))
    part = F.concat(F.col(value), F.lit(" ("), F.col("c").cast("string"), F.lit(")"))
    return ranked.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", part.alias("t")))), lambda x: x["t"]), " | ").alias("top"))


def cap_per_title(df: DataFrame, group: str, title: str, order: Sequence[Column], cap: int) -> DataFrame:
    """Rows of each group with at most ``cap`` of one title, in rank order; ``overflow`` on the last shown row of a
    title counts those left out. Rows without a title are exempt."""
    w = Window.partitionBy(group, title)
    ranked = df.withColumn("pos", F.row_number().over(w.orderBy(*order))).withColumn("of", F.count("*").over(w))
    exempt = X.missing(F.col(title))
    kept = ranked.where(exempt | (F.col("pos") <= cap))
    over = F.when(~exempt & (F.col("pos") == cap) & (F.col("of") > cap), F.col("of") - cap).otherwise(0)
    return kept.withColumn("overflow", over.cast("long")).drop("pos", "of")


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): non-empty values in alphabetical order as 1, 2, ...; what is missing has code 0. Distinct values
    are numbered in two steps (see ids_over), so that no task sees them all."""
    v = df.select(X.nonempty(F.col(column)).alias("value")).where("value IS NOT NULL").distinct()
    return ids_over(v, [F.col("value")], "%d").select("value", F.col("new_id").cast("long").alias("code"))


def year_spine(counts: DataFrame, year: str, n: str) -> DataFrame:
    """Every year from the first to the last, with 0 where there is none."""
    ends = counts.agg(F.min(year).alias("lo"), F.max(year).alias("hi"))
    spine = ends.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias(year))
    return spine.join(counts, year, "left").select(year, F.coalesce(F.col(n), F.lit(0)).alias(n))


def drops(series: DataFrame, year: str, n: str, rate: float = -0.35, least: int = -300) -> DataFrame:
    """Change from the year before, absolute and relative, a centred mean of five years, and whether it is a fall."""
    w = Window.orderBy(year)
    prev = F.lag(n).over(w)
    out = series.withColumn("prev", prev).withColumn("diff", F.col(n) - F.col("prev")).withColumn("pct", F.try_divide(F.col("diff"), F.col("prev")))
    out = out.withColumn("mean5", F.avg(n).over(w.rowsBetween(-2, 2)))
    return out.withColumn("fall", F.coalesce((F.col("pct") <= rate) & (F.col("diff") <= least), F.lit(False)))


def union_by_years(base: DataFrame, recovered: DataFrame, year: str, years: Sequence[int]) -> DataFrame:
    """Base rows outside the years, recovered rows inside them, columns aligned by name."""
    return base.where(~F.col(year).isin(*years)).unionByName(recovered.where(F.col(year).isin(*years)), allowMissingColumns=True)


def overlap_flags(left: DataFrame, right: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """Rows of ``left`` with a flag a key: whether ``right`` has a row with the same non-empty key."""
    out = left
    for flag, cols in keys.items():
        full = None
        for c in cols:
            ok = ~X.missing(F.col(c).cast("string"))
            full = ok if full is None else full & ok
        found = right.where(full).select(*[F.col(c) for c in cols]).distinct().withColumn(flag, F.lit(True))
        out = out.join(found, list(cols), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


def ids_over(df: DataFrame, order: Sequence[Column], pattern: str = "TH_%07d", parts: int = 0) -> DataFrame:
    """A dense id over a total order, numbered in two steps (rows of each range, then the ranges' offsets), so that no
    task sees all rows."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("c"))
    offsets = sizes.select("_p", (F.sum("c").over(Window.orderBy("_p")) - F.col("c")).alias("_o"))  # one row a range
    at = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_k", at).join(F.broadcast(offsets), "_p").withColumn("new_id", F.format_string(pattern, F.col("_k") + F.col("_o"))).drop("_p", "_k", "_o")


def ever_fell(level: str, group: str, order: str) -> Column:
    """True where a level is below the last known one before it in its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.col(level) < F.last(level, ignorenulls=True).over(w), F.lit(False))
