"""Composite queries around the neighbours of a document, and parsing of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.functions import parsing as J
from lumbrera.operators import textindex as N
from lumbrera.operators import vectors as V
from lumbrera.operators.relational import top_per
from lumbrera.queries import base, entry, queries_of, table
from lumbrera.queries.vectors import _T, _TE, near


def _zones(n: DataFrame) -> DataFrame:
    pulls = V.vote(n.where("cluster >= 0"), ["src"], "cluster", 1000).groupBy("src").agg(F.count_if(F.col("share") >= 0.06).alias("pulls"))
    all_ = n.select("src").distinct().join(pulls, "src", "left").na.fill(0, ["pulls"])
    return all_.withColumn("zone", F.when(F.col("pulls") <= 2, "definida").when(F.col("pulls") <= 5, "frontera").otherwise("dispersa"))


@entry(
    f"WITH {_T}, c AS (SELECT cluster, sum(sim * sim) AS w FROM near WHERE cluster >= 0 GROUP BY 1), z AS (SELECT cluster, round(w / sum(w) OVER (), 3) AS pull FROM c) SELECT count(*) FILTER (pull >= 0.06) AS pulls, CASE WHEN count(*) FILTER (pull >= 0.06) <= 2 THEN 'definida' WHEN count(*) FILTER (pull >= 0.06) <= 5 THEN 'frontera' ELSE 'dispersa' END AS zone FROM z"
)
def zone_hint(spark: SparkSession, d: str) -> DataFrame:
    """How many groups pull at a document, and what that says of its place."""
    return _zones(near(spark, d)).drop("src")


@entry(
    f"WITH {_TE}, c AS (SELECT src, cluster, sum(sim * sim) AS w FROM near WHERE cluster >= 0 GROUP BY 1, 2), z AS (SELECT src, round(w / sum(w) OVER (PARTITION BY src), 3) AS pull FROM c), p AS (SELECT src, count(*) FILTER (pull >= 0.06) AS pulls FROM z GROUP BY 1) SELECT n.src, coalesce(pulls, 0) AS pulls, CASE WHEN coalesce(pulls, 0) <= 2 THEN 'definida' WHEN pulls <= 5 THEN 'frontera' ELSE 'dispersa' END AS zone FROM (SELECT DISTINCT src FROM near) n LEFT JOIN p ON p.src = n.src"
)
def zone_hint_each(spark: SparkSession, d: str) -> DataFrame:
    return _zones(near(spark, d, each=True))


def _main(n: DataFrame) -> DataFrame:
    c = n.where("cluster >= 0 AND rank <= 20").groupBy("src", F.col("cluster").alias("main_cluster")).agg(F.count("*").alias("n"))
    return top_per(c, ["src"], 1, F.desc("n"), F.col("main_cluster")).drop("rank")


@entry(f"WITH {_T}, m AS (SELECT cluster, count(*) AS n FROM near WHERE cluster >= 0 AND rank <= 20 GROUP BY 1 ORDER BY n DESC, cluster LIMIT 1) SELECT cluster AS main_cluster, n FROM m")
def main_cluster(spark: SparkSession, d: str) -> DataFrame:
    return _main(near(spark, d)).drop("src")


@entry(f"WITH {_TE}, c AS (SELECT src, cluster, count(*) AS n FROM near WHERE cluster >= 0 AND rank <= 20 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY n DESC, cluster) AS k FROM c) SELECT src, cluster AS main_cluster, n FROM r WHERE k = 1")
def main_cluster_each(spark: SparkSession, d: str) -> DataFrame:
    return _main(near(spark, d, each=True))


@entry()
def context_payload(spark: SparkSession, d: str) -> DataFrame:
    """What is handed on about the context of each query: its nearest theses, capped, as JSON."""
    n = near(spark, d, each=True).where("rank <= 15").select("src", "rank", F.struct(F.substring("titulo_limpio", 1, 200).alias("titulo"), "anio", "sim").alias("t"))
    return n.groupBy("src").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rank", "t"))), lambda x: x["t"])).alias("payload"))


@entry("SELECT thesis_id, trim(regexp_replace(trim(lower(grado)), '^(?:(?:título de|licenciatura en|licenciatura de|maestría en|doctorado en|título)\\s+)+', '')) AS programa FROM base7_kaggle_clean WHERE grado IS NOT NULL")
def stripped_prefixes(spark: SparkSession, d: str) -> DataFrame:
    p = ["título de", "licenciatura en", "licenciatura de", "maestría en", "doctorado en", "título"]
    return base(spark, d).where("grado IS NOT NULL").select("thesis_id", J.strip_prefixes(F.lower("grado"), p).alias("programa"))


@entry("SELECT thesis_id, CASE WHEN regexp_matches(lower(programa), 'qu[ií]mic|f[ií]sic|ingenier') THEN 'fisico' WHEN regexp_matches(lower(programa), 'medic|enfermer|biolog|veterin') THEN 'vida' WHEN regexp_matches(lower(programa), 'derecho|econom|contad|sociol') THEN 'social' ELSE 'humanidades' END AS rama FROM base7_kaggle_clean WHERE programa IS NOT NULL")
def keyword_cascade(spark: SparkSession, d: str) -> DataFrame:
    rules = [("qu[ií]mic|f[ií]sic|ingenier", "fisico"), ("medic|enfermer|biolog|veterin", "vida"), ("derecho|econom|contad|sociol", "social")]
    return base(spark, d).where("programa IS NOT NULL").select("thesis_id", J.by_keyword(F.lower("programa"), rules, "humanidades").alias("rama"))


@entry()
def bibliography_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", J.reference_lines("text").alias("refs")).where(F.size("refs") > 0)


@entry("SELECT event_id, list_contains(CAST('[\"click\",\"view\"]' AS JSON)::VARCHAR[], event_type) AS listed FROM events")
def json_list_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", J.in_json_list(F.col("event_type"), F.lit('["click","view"]')).alias("listed"))


@entry()
def cluster_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Keywords of the titles of each group of theses, by class-based TF-IDF with pairs of words."""
    t = table(spark, d, "sample_50k_embeddings").where("cluster >= 0").select("vec_id", "thesis_id", "cluster").join(base(spark, d).select("thesis_id", "titulo_limpio"), "thesis_id")
    return N.class_tfidf(N.term_counts(t, "cluster", "vec_id", F.col("titulo_limpio")), "cluster")


QUERIES = queries_of(globals())
