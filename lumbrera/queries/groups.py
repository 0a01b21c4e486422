"""Queries of entity resolution and clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.operators import clustering as C
from lumbrera.operators import resolve as E
from lumbrera.operators import vectors as V
from lumbrera.plans.lineage import cut, settled
from lumbrera.queries import base, entry, queries_of, table
from lumbrera.queries.vectors import rows


def mentions(spark: SparkSession, d: str) -> DataFrame:
    return E.mentions(base(spark, d), "thesis_id", F.col("asesores_limpios_v2"), F.col("programa"))


@entry("WITH s AS (SELECT thesis_id, list_filter(list_transform(string_split(coalesce(asesores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> '') AS a FROM base7_kaggle_clean), l AS (SELECT thesis_id, list_filter(a, lambda x, i: list_position(a, x) = i) AS a FROM s) SELECT thesis_id, CAST(i AS INTEGER) AS orden, a[i] AS name FROM (SELECT thesis_id, a, unnest(generate_series(1, len(a))) AS i FROM l)")
def mention_rows(spark: SparkSession, d: str) -> DataFrame:
    return E.mentions(base(spark, d), "thesis_id", F.col("asesores_display"), F.col("programa")).select("thesis_id", "orden", "name")


@entry()
def advisor_groups(spark: SparkSession, d: str) -> DataFrame:
    return E.resolve(mentions(spark, d)).select("label", F.col("display").alias("tecnico"), "n", "regla")


@entry()
def advisor_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return E.catalogue(cut(E.resolve(mentions(spark, d)), "groups")).select("asesor_id", "nombre", "n_tesis", "n_variantes")


@entry()
def suspicious_pairs(spark: SparkSession, d: str) -> DataFrame:
    return E.suspicious(settled(lambda: E.resolve(mentions(spark, d)), "groups"))


@entry()
def principal_components(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    mean, w, share = C.principal(r, "v", 5)
    pc = C.project(r, "v", mean, w)
    return pc.select("id", *[F.round(F.col("pc")[i], 6).alias(f"pc{i + 1}") for i in range(len(share))])


@entry()
def centroid_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    c = V.centroids(rows(spark, d), "label", "v")
    return C.hierarchy(c, "label", 1.2, 0.9)


@entry()
def heterogeneous_parts(spark: SparkSession, d: str) -> DataFrame:
    c = cut(V.centroids(rows(spark, d), "label", "v"), "centroids")
    return C.heterogeneous(c, C.hierarchy(c, "label", 1.4, 0.9), "label")


@entry("WITH p AS (SELECT DISTINCT macroid AS macro_id, clusterid AS meso_id FROM cluster_nodes_final_50k WHERE clusterid IS NOT NULL AND macroid IS NOT NULL) SELECT meso_id, CAST(CASE WHEN meso_id = 1 THEN (SELECT max(macro_id) + 1 FROM p) WHEN meso_id = 2 THEN 7 ELSE macro_id END AS BIGINT) AS macro_id FROM p")
def edited_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "cluster_nodes_final_50k").where("clusterid IS NOT NULL AND macroid IS NOT NULL").select(F.col("macroid").cast("long").alias("macro_id"), F.col("clusterid").alias("meso_id")).distinct()
    edits = spark.createDataFrame([(1, None), (2, 7)], "meso_id int, target long")
    return C.edited(p, edits).select("meso_id", "macro_id")


@entry()
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sample_50k_embeddings").where(V.has_direction(F.col("embedding"))).select(F.col("vec_id").alias("id"), V.unit(F.col("embedding")).alias("v"))
    return C.density_clusters(cut(t, "unit-vectors"), min_cluster=10, min_samples=3, k=15)


@entry()
def softened_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The older run's noise, reassigned where a group's centroid is close enough."""
    t = cut(table(spark, d, "sample_50k_embeddings").where(V.has_direction(F.col("embedding"))).select(F.col("vec_id").alias("id"), "cluster", V.unit(F.col("embedding")).alias("v")), "unit-vectors")
    c = V.centroids(t.where("cluster >= 0"), "cluster", "v").select(F.col("cluster").cast("long").alias("id"), F.col("centroid").alias("v"))
    close = V.nearest(t.where("cluster = -1"), c).select(F.col("src").alias("id"), F.col("cand").cast("int").alias("cluster"), F.col("sim").alias("c"))
    return C.soften(t.select("id", "cluster"), close, 0.5)


QUERIES = queries_of(globals())
