"""Writing tables, shards, reports, grouped documents and packed arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbrera.operators.profile import changes


def table(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Parquet with zstd, by partition columns if there are any; the committer makes it atomic."""
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def missing_shards(df: DataFrame, path: str, shard: str) -> DataFrame:
    """Rows of shards that a folder written by ``table(.., partition=[shard])`` doesn't have yet: what a resumed job
    still has to do."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return df
    done = spark.read.parquet(path).select(F.col(shard).alias("done")).distinct()
    return df.join(done, df[shard] == F.col("done"), "left_anti")


def append_shards(df: DataFrame, path: str, shard: str) -> None:
    missing_shards(df, path, shard).write.mode("append").option("compression", "zstd").partitionBy(shard).parquet(path)


def report(df: DataFrame, path: str) -> None:
    """CSV files with a header, a file a task; quotes, line breaks and outer blanks come back as they were."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def documents(df: DataFrame, path: str, key: str, order: Sequence[Column]) -> None:
    """One JSON document a group: {key, rows}, rows by ascending ``order`` (negate numbers for descending)."""
    rows = F.array_sort(F.collect_list(F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.struct(*[c for c in df.columns if c != key]).alias("row"))))
    df.groupBy(key).agg(F.transform(rows, lambda r: r["row"]).alias("rows")).write.mode("overwrite").json(path)


def versioned(df: DataFrame, old: DataFrame, path: str, column: str, rule: str) -> DataFrame:
    """Writes a corrected table as a new version and returns the audit (original, new, rows, rule) of the column that
    the correction was about; the old version stays."""
    table(df, path)
    key = [c for c in old.columns if c != column][0]
    both = old.select(key, F.col(column).alias("_old")).join(df.select(key, F.col(column).alias("_new")), key)
    return changes(both, F.col("_old"), F.col("_new")).select(F.col("before").alias("original"), F.col("after").alias("nuevo"), F.col("n").alias("filas"), F.lit(rule).alias("regla"))


def packed(df: DataFrame, order: Sequence[Column], dtypes: dict[str, str], block: int = 100_000) -> DataFrame:
    """(block, count, content): columns as typed arrays one after another, a blob for each range of rows in order.
    Rows are numbered in two steps (see ids_over), so that no task sees them all."""
    from lumbrera.operators.relational import ids_over

    numbered = ids_over(df, order, "%d").withColumn("row", F.col("new_id").cast("long") - 1).withColumn("block", F.expr(f"row div {block}"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        content = b"".join(pdf[c].to_numpy().astype(np.dtype(t).newbyteorder("<")).tobytes() for c, t in dtypes.items())
        return pd.DataFrame({"block": [key[0]], "count": [len(pdf)], "content": [content]})

    return numbered.select("block", "row", *dtypes).groupBy("block").applyInPandas(pack, "block long, count long, content binary")


def packed_manifest(count: int, dtypes: dict[str, str]) -> list[dict]:
    """Where each array of a blob of ``count`` rows begins."""
    out, at = [], 0
    for c, t in dtypes.items():
        out.append({"name": c, "dtype": t, "byteOffset": at, "count": count})
        at += count * np.dtype(t).itemsize
    return out


def artefacts(df: DataFrame, tables: dict[str, DataFrame], policy: dict[str, str]) -> DataFrame:
    """(name, rows, columns, policy): a manifest of what a release holds."""
    spark = df.sparkSession
    return spark.createDataFrame([(n, t.count(), len(t.columns), policy.get(n, "interno")) for n, t in tables.items()], "name string, rows long, columns int, policy string")


def sse(df: DataFrame, event: Column, payload: Column) -> DataFrame:
    """(frame): rows as server-sent events."""
    return df.select(F.concat(F.lit("event: "), event, F.lit("\ndata: "), F.to_json(payload), F.lit("\n\n")).alias("frame"))


def append_lines(df: DataFrame, path: str) -> None:
    """Rows appended as JSON lines; each write adds files, so writers don't wait for each other."""
    df.write.mode("append").json(path)
