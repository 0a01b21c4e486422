"""Connected components by propagation of minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.plans.lineage import cut, drop


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that links (a, b) reach, for every id of a link.

    Every id points to a smaller one, or to itself. In a round each id looks at what its neighbours' pointers point to:
    the least of these is offered to the id and to what the id points to, so whole trees are hooked at once, and
    pointers are halved. Rounds grow with the logarithm of the number of ids; they end when no pointer moves. The
    result of every round is written out, which cuts its lineage; nothing is collected but whether a pointer moved."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = cut(links.where("a <> b").select(ends.alias("e")).select("e.a", "e.b").distinct(), "links")
    now = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        far = now.join(now.select(F.col("id").alias("label"), F.col("label").alias("far")), "label")
        offered = both.join(far.select(F.col("id").alias("b"), "far"), "b").groupBy("a").agg(F.min("far").alias("m"))
        seen = far.join(offered, far["id"] == offered["a"])
        own = F.struct(F.col("id").alias("id"), F.least("far", "m").alias("to"), F.col("label").alias("old"))
        above = F.struct(F.col("label").alias("id"), F.col("m").alias("to"), F.lit(None).cast("long").alias("old"))
        told = seen.select(F.explode(F.array(own, above)).alias("t")).select("t.*").groupBy("id").agg(F.min("to").alias("to"), F.max("old").alias("old"))
        new = cut(told.select("id", F.least("to", "old").alias("label"), (F.col("to") < F.col("old")).alias("moved")), "labels")
        done = not new.where("moved").limit(1).count()
        drop(now)
        now = new.select("id", "label")
        if done:
            drop(both)
            return now


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, label) after links (a, b) between labels have merged some of them."""
    moved = components(links)
    return cut(labels.join(moved, labels["label"] == moved["id"], "left").select("node", F.coalesce(moved["label"], labels["label"]).alias("label")), "labels")
