"""Profiles, audits and summaries of tables, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.functions import text as X


def coverage(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, total, non_empty, pct, distinct_values) for every column. All counts come from one scan; distinct
    values are counted over (column, value) pairs, so they need one exchange and no per-column pass."""
    names = list(columns or df.columns)
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), X.nonempty(F.col(f"`{c}`").cast("string")).alias("v")) for c in names])).alias("x")).select("x.column", "x.v")
    values = cells.groupBy("column", "v").agg(F.count("*").alias("n"))
    filled = F.col("v").isNotNull()
    out = values.groupBy("column").agg(F.sum("n").alias("total"), F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("non_empty"), F.sum(filled.cast("long")).alias("distinct_values"))
    return out.select("column", "total", "non_empty", F.round(F.col("non_empty") * 100.0 / F.col("total"), 4).alias("pct"), "distinct_values")


def column_decision(pct: Column, distinct: Column, total: Column) -> Column:
    """What to do with a column, from its coverage."""
    return F.when(pct == 0, "eliminar").when(distinct == total, "llave").when(pct < 5, "archivar").when(distinct <= 50, "categoria").otherwise("conservar")


def changes(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """(before, after, n) of the values that a correction changed."""
    pair = df.select(before.alias("before"), after.alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))
    return pair.groupBy("before", "after").agg(F.count("*").alias("n"))


def undetermined(df: DataFrame, cause: str, effect: str) -> DataFrame:
    """(cause, effects): causes with more than one effect; empty where the effect follows from the cause."""
    pairs = df.select(cause, effect).distinct()  # repeated rows go before the exchange by cause
    return pairs.groupBy(cause).agg(F.count(effect).alias("effects")).where("effects > 1")


def duplicate_rate(df: DataFrame, key: Column) -> DataFrame:
    """One row: the share of rows whose key another row has as well."""
    groups = df.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    return groups.agg((F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"))


#: What may be wrong with a name, and the pattern that shows it.
NAME_FLAGS = {
    "sin_coma": r"^[^,]+$", "con_digitos": r"\d", "con_parentesis": r"[()]", "con_punto_final": r"\.$", "doble_espacio": r"\s{2,}", "minusculas": r"^[^A-ZÁÉÍÓÚÑÜ]+$",
    "mayusculas": r"^[^a-záéíóúñü]+$", "una_palabra": r"^\S+$", "titulo": r"(?i)\b(dra?|mtr[oa]|lic|ing|prof)\.", "varias_comas": r",.*,", "signo_raro": r"[^\p{L}\s,.'()\d-]",
}


def flags(name: Column) -> list[Column]:
    return [name.rlike(p).alias(k) for k, p in NAME_FLAGS.items()]


def flag_summary(df: DataFrame, names: Column) -> DataFrame:
    """(flag, n, total) over all names of an array column."""
    each = df.select(F.explode(names).alias("name")).select(*flags(F.col("name")))
    sums = each.agg(F.count("*").alias("total"), *[F.count_if(k).alias(k) for k in NAME_FLAGS])
    return sums.unpivot(["total"], list(NAME_FLAGS), "flag", "n").select("flag", "n", "total")


def crosstab_share(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of the given values of ``column`` by ``row`` as shares of their sum. For all values, see crosstab_long."""
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return wide.select(row, *[F.round(F.try_divide(F.col(f"`{v}`"), total), 4).alias(str(v)) for v in values])


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, share): every value of ``column``, null as well, in every ``row``, as shares of all rows of it;
    cells without rows have 0. The values are a table, so any number of them is possible."""
    counts = df.groupBy(F.col(row).alias("r"), F.col(column).alias("v")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("r").agg(F.sum("n").alias("total"))
    cells = totals.select("r", F.lit(0).cast("long").alias("n")).crossJoin(counts.select("v").distinct())  # the result has these rows
    full = counts.unionByName(cells).groupBy("r", "v").agg(F.sum("n").alias("n")).join(totals.withColumnRenamed("r", "of"), F.col("r").eqNullSafe(F.col("of")))
    return full.select(F.col("r").alias(row), F.col("v").alias(column), "n", F.round(F.col("n") / F.col("total"), 4).alias("share"))


def enrichment(df: DataFrame, inside: Column, value: str) -> DataFrame:
    """(value, inside_share, global_share, ratio): how much commoner a value is in a subset than altogether."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"), F.count_if(inside).alias("m"))
    w = Window.partitionBy(F.lit(1))  # over one row a value
    shares = counts.select(value, (F.col("m") / F.sum("m").over(w)).alias("a"), (F.col("n") / F.sum("n").over(w)).alias("b"))
    return shares.select(value, F.round("a", 6).alias("inside_share"), F.round("b", 6).alias("global_share"), F.round(F.try_divide("a", "b"), 4).alias("ratio"))


def quantised(df: DataFrame, column: str, lo: float = 0.005, hi: float = 0.995, steps: int = 1000) -> DataFrame:
    """The column clamped to its percentiles lo..hi and scaled to whole numbers 0..steps, as column ``q``."""
    ends = df.agg(F.expr(f"percentile_disc({lo}) WITHIN GROUP (ORDER BY {column})").alias("lo"), F.expr(f"percentile_disc({hi}) WITHIN GROUP (ORDER BY {column})").alias("hi"))
    c = F.greatest(F.least(F.col(column), F.col("hi")), F.col("lo"))
    return df.crossJoin(F.broadcast(ends)).withColumn("q", F.floor(F.try_divide(c - F.col("lo"), F.col("hi") - F.col("lo")) * steps + 0.5)).drop("lo", "hi")  # ends: one row
