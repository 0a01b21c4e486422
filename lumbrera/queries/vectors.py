"""Queries of vector search. Searches ask with every row whose id is divisible by 20, against all rows; those whose SQL
asks with the row of smallest id have a companion of their name and ``_each`` that asks with every such row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.functions import text as X
from lumbrera.operators import vectors as V
from lumbrera.operators.relational import top_per
from lumbrera.plans.lineage import cut
from lumbrera.queries import base, entry, queries_of, table


def rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where(V.has_direction(F.col("embedding"))).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), F.col("label").cast("long").alias("label"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d).where("id % 20 = 0")


def theses(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of theses, scaled to length 1, with the records they belong to."""
    v = table(spark, d, "sample_50k_embeddings").where(V.has_direction(F.col("embedding"))).select(F.col("vec_id").alias("id"), "thesis_id", "cluster", V.unit(F.col("embedding")).alias("v"))
    return v.join(base(spark, d).select("thesis_id", F.col("año").alias("anio"), "programa", "plantel_display", "area", "titulo_limpio", "asesores_display"), "thesis_id", "left")


def near(spark: SparkSession, d: str, n: int = 100, each: bool = False) -> DataFrame:
    """The n theses nearest to each query ``src``: the vector of smallest id, or every one whose id is divisible by 20."""
    t = theses(spark, d)
    q = t.where("id % 20 = 0") if each else t.orderBy("id").limit(1)
    found = V.knn(q.select("id", "v"), t, n, decimals=4)
    return cut(found.select("src", F.col("dst").alias("id"), "sim", "rank").join(t.drop("v"), "id"), "near")


_E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS BIGINT) AS label FROM embeddings)"
_K = f"{_E}, s AS (SELECT a.id AS src, b.id AS dst, round(list_inner_product(a.v, b.v), 6) AS sim FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 20 = 0), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rank FROM s)"


@entry(f"WITH {_K} SELECT src, dst, sim, rank FROM k WHERE rank <= 10")
def knn_exact(spark: SparkSession, d: str) -> DataFrame:
    return V.knn(asked(spark, d), rows(spark, d), 10)


@entry(f"WITH {_E}, q AS (SELECT v FROM e ORDER BY id LIMIT 1) SELECT id, round(list_inner_product(e.v, q.v), 4) AS sim FROM e, q ORDER BY sim DESC, id LIMIT 20")
def query_topk(spark: SparkSession, d: str) -> DataFrame:
    q = rows(spark, d).orderBy("id").limit(1).collect()[0]["v"]
    qv = F.array(*[F.lit(float(x)) for x in q])
    return rows(spark, d).select("id", F.round(V.dot(F.col("v"), qv), 4).alias("sim")).orderBy(F.desc("sim"), "id").limit(20)


@entry(f"WITH {_E}, s AS (SELECT a.id AS src, b.id, round(list_inner_product(a.v, b.v), 4) AS sim FROM e a, e b WHERE a.id % 20 = 0), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, id) AS rank FROM s) SELECT src, id, sim, rank FROM k WHERE rank <= 20")
def query_topk_each(spark: SparkSession, d: str) -> DataFrame:
    return V.knn(asked(spark, d), rows(spark, d), 20, exclude_self=False, decimals=4).select("src", F.col("dst").alias("id"), "sim", "rank")


@entry()
def knn_inverted_lists(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    index = V.InvertedLists(r, lists=64)
    return index.search(asked(spark, d), 10, probes=36)


@entry()
def inverted_lists_recall(spark: SparkSession, d: str) -> DataFrame:
    found = cut(knn_inverted_lists(spark, d), "found")
    return V.recall(found, V.knn(asked(spark, d), rows(spark, d), 10), 10).agg(F.round(F.avg("recall"), 4).alias("recall"), F.count("*").alias("queries"))


_VOTE = f"WITH {_K}, w AS (SELECT src, e.label, sum(sim * sim) AS w FROM k JOIN e ON e.id = k.dst WHERE rank <= 30 GROUP BY 1, 2), r AS (SELECT *, round(w / sum(w) OVER (PARTITION BY src), 3) AS share, row_number() OVER (PARTITION BY src ORDER BY round(w, 6) DESC, label) AS rk FROM w)"


def _votes(spark: SparkSession, d: str) -> DataFrame:
    k = V.knn(asked(spark, d), rows(spark, d), 30)
    return k.join(rows(spark, d).select(F.col("id").alias("dst"), "label"), "dst")


@entry(f"{_VOTE} SELECT src, label, round(w, 4) AS weight, share, rk AS rank FROM r WHERE rk <= 4")
def weighted_vote(spark: SparkSession, d: str) -> DataFrame:
    return V.vote(_votes(spark, d), ["src"], "label")


@entry(f"{_VOTE}, m AS (SELECT src, avg(sim) AS mean10, max(sim) AS top FROM k WHERE rank <= 10 GROUP BY 1) SELECT m.src, round(mean10, 4) AS mean10, round(top, 4) AS top, CASE WHEN mean10 < 0.80 THEN 'ninguna' WHEN share >= 0.6 AND mean10 >= 0.86 THEN 'clara' WHEN share >= 0.35 THEN 'entre' ELSE 'dispersa' END AS lectura FROM m JOIN r ON r.src = m.src AND rk = 1")
def context_reading(spark: SparkSession, d: str) -> DataFrame:
    votes = cut(_votes(spark, d), "votes")
    m = votes.where("rank <= 10").groupBy("src").agg(F.avg("sim").alias("mean10"), F.max("sim").alias("top"))
    lead = V.vote(votes, ["src"], "label", 1).select("src", "share")
    return m.join(lead, "src").select("src", F.round("mean10", 4).alias("mean10"), F.round("top", 4).alias("top"), V.reading(F.col("mean10"), F.col("share")).alias("lectura"))


@entry(f"WITH {_K} SELECT src, round(sum(sim * sim * e.v[1]) / sum(sim * sim), 4) AS x, round(sum(sim * sim * e.v[2]) / sum(sim * sim), 4) AS y FROM k JOIN e ON e.id = k.dst WHERE rank <= 10 GROUP BY 1")
def weighted_position(spark: SparkSession, d: str) -> DataFrame:
    k = V.knn(asked(spark, d), rows(spark, d), 10).join(rows(spark, d).select(F.col("id").alias("dst"), F.col("v")[0].cast("double").alias("x"), F.col("v")[1].cast("double").alias("y")), "dst")
    w = F.col("sim") * F.col("sim")
    return k.groupBy("src").agg(F.round(F.sum(w * F.col("x")) / F.sum(w), 4).alias("x"), F.round(F.sum(w * F.col("y")) / F.sum(w), 4).alias("y"))


@entry(f"WITH {_K}, n AS (SELECT dst, count(*) AS n FROM k WHERE rank = 1 GROUP BY 1), t AS (SELECT n FROM n ORDER BY n DESC, dst LIMIT 15) SELECT round((SELECT sum(n) FROM t) / (SELECT sum(n) FROM n), 6) AS share")
def hub_concentration(spark: SparkSession, d: str) -> DataFrame:
    return V.hub_share(V.knn(asked(spark, d), rows(spark, d), 1), "dst", 15).select(F.round("share", 6).alias("share"))


@entry(f"WITH {_K} SELECT round(avg(CAST(sim > 0.999 AS INTEGER)), 6) AS rate, round(quantile_cont(sim, 0.5), 4) AS med FROM k WHERE rank = 1")
def near_copies_rate(spark: SparkSession, d: str) -> DataFrame:
    k = V.knn(asked(spark, d), rows(spark, d), 1)
    return k.agg(F.round(F.avg((F.col("sim") > 0.999).cast("int")), 6).alias("rate"), F.round(F.median("sim"), 4).alias("med"))


@entry(f"WITH {_K} SELECT src, dst, CAST(greatest(least(round_even((round(sim, 4) - 0.5) * 510, 0), 255), 0) AS INTEGER) AS q FROM k WHERE rank <= 10")
def sim_quantised(spark: SparkSession, d: str) -> DataFrame:
    return V.knn(asked(spark, d), rows(spark, d), 10).select("src", "dst", V.quantise(F.round("sim", 4)).alias("q"))


_CENT = "g AS (SELECT label, count(*) AS n, [" + ", ".join(f"avg(v[{i}])" for i in range(1, 65)) + "] AS m FROM e WHERE label IS NOT NULL GROUP BY 1), c AS (SELECT label, n, list_transform(m, lambda x: x / sqrt(list_inner_product(m, m))) AS c FROM g)"


def _cents(spark: SparkSession, d: str) -> DataFrame:
    return V.centroids(rows(spark, d), "label", "v")


@entry(f"WITH {_E}, {_CENT} SELECT label, n, i AS dim, round(c[i + 1], 4) AS value FROM c, (SELECT unnest(range(64)) AS i)")
def centroids(spark: SparkSession, d: str) -> DataFrame:
    return _cents(spark, d).select("label", "n", F.posexplode("centroid").alias("dim", "value")).select("label", "n", F.col("dim").cast("long").alias("dim"), F.round("value", 4).alias("value"))


@entry(f"WITH {_E}, {_CENT}, w AS (SELECT label % 3 AS parent, n, c FROM c), t AS (SELECT parent, CAST(sum(n) AS BIGINT) AS n, " + ", ".join(f"sum(n * c[{i}]) / sum(n) AS d{i}" for i in range(1, 65)) + " FROM w GROUP BY 1), u AS (SELECT parent, n, [" + ", ".join(f"d{i}" for i in range(1, 65)) + "] AS m FROM t) SELECT parent, n, round(m[1] / sqrt(list_inner_product(m, m)), 4) AS first_value FROM u")
def merged_centroids(spark: SparkSession, d: str) -> DataFrame:
    c = _cents(spark, d).withColumn("parent", F.col("label") % 3)
    return V.merge_centroids(c, "parent", "n", "centroid").select("parent", "n", F.round(F.col("centroid")[0], 4).alias("first_value"))


@entry(f"WITH {_E}, {_CENT}, r AS (SELECT e.label, e.id, round(list_inner_product(e.v, c.c), 4) AS sim FROM e JOIN c ON c.label = e.label), k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, id) AS rank FROM r) SELECT label, id, sim, rank FROM k WHERE rank <= 25")
def nearest_to_centroid(spark: SparkSession, d: str) -> DataFrame:
    c = V.against(rows(spark, d), _cents(spark, d).select(F.col("label").alias("id"), F.col("centroid").alias("v")))
    own = c.join(rows(spark, d).select(F.col("id").alias("src"), "label"), "src").where("cand = label").select("label", F.col("src").alias("id"), F.round("sim", 4).alias("sim"))
    return top_per(own, ["label"], 25, F.desc("sim"), F.col("id")).select("label", "id", "sim", F.col("rank").cast("long").alias("rank"))


@entry(
    "WITH e AS (SELECT vec_id AS id, thesis_id, cluster, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM sample_50k_embeddings WHERE cluster >= 0 AND embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0), "
    "m AS (SELECT cluster, d, sum(v[d] / n) AS x FROM e, generate_series(1, 96) AS g(d) GROUP BY 1, 2), l AS (SELECT cluster, sqrt(sum(x * x)) AS l FROM m GROUP BY 1), c AS (SELECT cluster, list(x / l ORDER BY d) AS c FROM m JOIN l USING (cluster) GROUP BY 1), s AS (SELECT e.cluster, e.id, round(list_inner_product(e.v, c.c) / e.n, 4) AS sim, coalesce(b.titulo_normalizado, '') AS t FROM e JOIN c USING (cluster) LEFT JOIN base7_kaggle_clean b USING (thesis_id)), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY cluster, CASE WHEN t = '' THEN CAST(id AS VARCHAR) ELSE 't' || t END ORDER BY sim DESC, id) AS one FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sim DESC, id) AS rank FROM o WHERE one = 1) SELECT cluster, id, sim, rank FROM k WHERE rank <= 10"
)
def nearest_titles(spark: SparkSession, d: str) -> DataFrame:
    """The ten theses nearest to the middle of each group, each title once; theses without a title stay apart."""
    t = cut(table(spark, d, "sample_50k_embeddings").where("cluster >= 0").where(V.has_direction(F.col("embedding"))).select(F.col("vec_id").alias("id"), "thesis_id", F.col("cluster").alias("cluster"), V.unit(F.col("embedding")).alias("v")), "grouped")
    own = t.join(V.centroids(t, "cluster", "v").select("cluster", "centroid"), "cluster").join(base(spark, d).select("thesis_id", F.coalesce("titulo_normalizado", F.lit("")).alias("t")), "thesis_id", "left")
    s = own.select("cluster", "id", F.round(V.dot(F.col("v"), F.col("centroid")), 4).alias("sim"), F.when(F.coalesce("t", F.lit("")) == "", F.col("id").cast("string")).otherwise(F.concat(F.lit("t"), "t")).alias("title"))
    once = top_per(s, ["cluster", "title"], 1, F.desc("sim"), F.col("id")).drop("rank")
    return top_per(once, ["cluster"], 10, F.desc("sim"), F.col("id")).select("cluster", "id", "sim", F.col("rank").cast("long").alias("rank"))


@entry(f"WITH {_E}, {_CENT}, s AS (SELECT a.label AS a, b.label AS b, round(list_inner_product(a.c, b.c), 4) AS sim FROM c a JOIN c b ON a.label <> b.label), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS r FROM s) SELECT least(a, b) AS source, greatest(a, b) AS target, max(sim) AS sim FROM k WHERE r <= 5 AND sim > 0 GROUP BY 1, 2")
def centroid_edges(spark: SparkSession, d: str) -> DataFrame:
    c = cut(_cents(spark, d).select(F.col("label").alias("id"), F.col("centroid").alias("v")), "centroids")
    s = V.against(c, c).where("src <> cand").withColumn("sim", F.round("sim", 4))
    return V.undirected(top_per(s, ["src"], 5, F.desc("sim"), F.col("cand")).where("sim > 0"), "src", "cand", "sim")


@entry(f"WITH {_E}, s AS (SELECT a.id AS src, b.id AS dst, round(list_inner_product(a.v, b.v), 6) AS sim, a.label = b.label AS same FROM e a JOIN e b ON a.id <> b.id), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS r FROM s), i AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY r) AS pos FROM k WHERE r <= 30 AND same) SELECT least(src, dst) AS source, greatest(src, dst) AS target, max(sim) AS sim FROM i WHERE pos <= 3 GROUP BY 1, 2")
def intra_edges(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    k = V.knn(r, r, 30)
    lab = r.select("id", "label")
    same = k.join(lab.withColumnRenamed("id", "src").withColumnRenamed("label", "a"), "src").join(lab.withColumnRenamed("id", "dst").withColumnRenamed("label", "b"), "dst").where("a = b")
    three = top_per(same.drop("a", "b").withColumnRenamed("rank", "r"), ["src"], 3, F.col("r"))
    return V.undirected(three, "src", "dst", "sim")


_SIMS = f"{_E}, {_CENT}, s AS (SELECT e.id AS src, c.label AS cand, list_inner_product(e.v, c.c) AS sim FROM e, c)"


def _sims(spark: SparkSession, d: str) -> DataFrame:
    return V.against(rows(spark, d), _cents(spark, d).select(F.col("label").alias("id"), F.col("centroid").alias("v")))


@entry(f"WITH {_SIMS}, z AS (SELECT src, cand, sim, round((sim - avg(sim) OVER (PARTITION BY cand)) / sqrt(greatest(var_pop(sim) OVER (PARTITION BY cand), 1e-12)), 4) AS z FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY z DESC, cand) AS rank FROM z) SELECT src, cand, round(sim, 4) AS sim, z, rank FROM k WHERE rank <= 3")
def zscore_topk(spark: SparkSession, d: str) -> DataFrame:
    return V.hubness_corrected(_sims(spark, d), "cand", "src", 3).select("src", "cand", F.round("sim", 4).alias("sim"), "z", F.col("rank").cast("long").alias("rank"))


@entry(
    f"WITH {_SIMS}, z AS (SELECT src, cand, round((sim - avg(sim) OVER (PARTITION BY src)) / sqrt(greatest(var_pop(sim) OVER (PARTITION BY src), 1e-12)), 4) AS z FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY z DESC, cand) AS r, max(z) OVER (PARTITION BY src) AS m FROM z) "
    "SELECT src, round(sum(exp(2 * (z - m)) * c.c[1]) / sum(exp(2 * (z - m))), 4) AS x, round(sum(exp(2 * (z - m)) * c.c[2]) / sum(exp(2 * (z - m))), 4) AS y FROM k JOIN c ON c.label = k.cand WHERE r <= 25 GROUP BY src"
)
def interpolated_position(spark: SparkSession, d: str) -> DataFrame:
    z = V.hubness_corrected(_sims(spark, d), "src", "src", 25)
    top = z.groupBy("src").agg(F.max("z").alias("m"))
    c = _cents(spark, d).select(F.col("label").alias("cand"), F.col("centroid")[0].alias("cx"), F.col("centroid")[1].alias("cy"))
    w = F.exp(2 * (F.col("z") - F.col("m")))
    return z.join(top, "src").join(c, "cand").groupBy("src").agg(F.round(F.sum(w * F.col("cx")) / F.sum(w), 4).alias("x"), F.round(F.sum(w * F.col("cy")) / F.sum(w), 4).alias("y"))


@entry(f"WITH {_SIMS} SELECT cand, count(*) AS n, round(avg(sim), 4) AS mean, round(stddev_pop(sim), 4) AS sd FROM s GROUP BY 1")
def candidate_moments(spark: SparkSession, d: str) -> DataFrame:
    return _sims(spark, d).groupBy("cand").agg(F.count("*").alias("n"), F.round(F.avg("sim"), 4).alias("mean"), F.round(F.stddev_pop("sim"), 4).alias("sd"))


@entry(f"WITH {_K}, a AS (SELECT * FROM k WHERE rank <= 10), b AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(sim, 2) DESC, dst) AS r2 FROM k), h AS (SELECT a.src, count(b.dst) AS hits FROM a LEFT JOIN b ON a.src = b.src AND a.dst = b.dst AND b.r2 <= 10 GROUP BY 1) SELECT src, round(hits / 10, 4) AS recall FROM h")
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    truth = V.knn(asked(spark, d), rows(spark, d), 10)
    coarse = V.knn(asked(spark, d), rows(spark, d), 10, decimals=2)
    return V.recall(coarse, truth, 10).select("src", F.round("recall", 4).alias("recall"))


_T = "t AS (SELECT vec_id AS id, thesis_id, cluster, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM sample_50k_embeddings WHERE embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0), q AS (SELECT * FROM t ORDER BY id LIMIT 1), s AS (SELECT t.id, t.thesis_id, t.cluster, round(list_inner_product(t.e, q.e) / t.n / q.n, 4) AS sim FROM t, q WHERE t.id <> q.id), k AS (SELECT *, row_number() OVER (ORDER BY sim DESC, id) AS rank FROM s), near AS (SELECT k.*, b.\"año\" AS anio, b.programa, b.plantel_display, b.area, b.titulo_limpio, b.asesores_display FROM k LEFT JOIN base7_kaggle_clean b USING (thesis_id) WHERE rank <= 100)"


_TE = "t AS (SELECT vec_id AS id, thesis_id, cluster, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM sample_50k_embeddings WHERE embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0), s AS (SELECT q.id AS src, t.id, t.thesis_id, t.cluster, round(list_inner_product(t.e, q.e) / t.n / q.n, 4) AS sim FROM t, t AS q WHERE q.id % 20 = 0 AND t.id <> q.id), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, id) AS rank FROM s), near AS (SELECT k.*, b.\"año\" AS anio, b.programa, b.plantel_display, b.area, b.titulo_limpio, b.asesores_display FROM k LEFT JOIN base7_kaggle_clean b USING (thesis_id) WHERE rank <= 100)"


def _analysis(n: DataFrame, digits: int = 6) -> DataFrame:
    m = n.groupBy("src").agg(F.count("*").alias("neighbours"), F.count_if(F.col("cluster") >= 0).alias("grouped"), F.round(F.max("sim"), 4).alias("sim_max"), F.avg(F.when(F.col("rank") <= 10, F.col("sim"))).alias("mean10"))
    lead = V.vote(n.where("cluster >= 0"), ["src"], "cluster", 1).select("src", "cluster", "share")
    return m.join(lead, "src", "left").select("src", "neighbours", "grouped", "sim_max", F.round("mean10", digits).alias("sim_mean10"), "cluster", "share", V.reading(F.col("mean10"), F.col("share")).alias("lectura"))


@entry(
    f"WITH {_T}, w AS (SELECT cluster, sum(sim * sim) AS w FROM near WHERE cluster IS NOT NULL AND cluster >= 0 GROUP BY 1), v AS (SELECT cluster, round(w / sum(w) OVER (), 3) AS share, row_number() OVER (ORDER BY round(w, 6) DESC, cluster) AS r FROM w), m AS (SELECT avg(sim) FILTER (rank <= 10) AS mean10, max(sim) AS top, count(*) FILTER (cluster >= 0) AS grouped, count(*) AS n FROM near) "
    "SELECT n AS neighbours, grouped, round(top, 4) AS sim_max, round(mean10, 4) AS sim_mean10, (SELECT cluster FROM v WHERE r = 1) AS cluster, (SELECT share FROM v WHERE r = 1) AS share, CASE WHEN mean10 < 0.80 THEN 'ninguna' WHEN (SELECT share FROM v WHERE r = 1) >= 0.6 AND mean10 >= 0.86 THEN 'clara' WHEN (SELECT share FROM v WHERE r = 1) >= 0.35 THEN 'entre' ELSE 'dispersa' END AS lectura FROM m"
)
def context_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Where a document falls in the corpus: neighbours, leading group and its share, how clear that reading is."""
    return _analysis(near(spark, d), 4).drop("src")


@entry(
    f"WITH {_TE}, w AS (SELECT src, cluster, sum(sim * sim) AS w FROM near WHERE cluster >= 0 GROUP BY 1, 2), v AS (SELECT src, cluster, round(w / sum(w) OVER (PARTITION BY src), 3) AS share, row_number() OVER (PARTITION BY src ORDER BY round(w, 6) DESC, cluster) AS r FROM w), m AS (SELECT src, avg(sim) FILTER (rank <= 10) AS mean10, max(sim) AS top, count(*) FILTER (cluster >= 0) AS grouped, count(*) AS n FROM near GROUP BY 1) "
    "SELECT m.src, n AS neighbours, grouped, round(top, 4) AS sim_max, round(mean10, 6) AS sim_mean10, v.cluster, v.share, CASE WHEN mean10 < 0.80 THEN 'ninguna' WHEN v.share >= 0.6 AND mean10 >= 0.86 THEN 'clara' WHEN v.share >= 0.35 THEN 'entre' ELSE 'dispersa' END AS lectura FROM m LEFT JOIN v ON v.src = m.src AND v.r = 1"
)
def context_analysis_each(spark: SparkSession, d: str) -> DataFrame:
    return _analysis(near(spark, d, each=True))


def _advisors(n: DataFrame) -> DataFrame:
    a = n.where(~X.missing(F.col("asesores_display"))).select("src", "id", "sim", F.explode(X.clean_list(F.col("asesores_display"))).alias("asesor"))
    scores = a.groupBy("src", "asesor").agg(F.count("*").alias("n"), F.round(F.sum(F.col("sim") * F.col("sim")), 4).alias("score"))
    return top_per(scores, ["src"], 15, F.desc("score"), F.col("asesor"))


@entry(f"WITH {_T}, a AS (SELECT DISTINCT id, sim, unnest(list_filter(list_transform(string_split(asesores_display, '|'), lambda x: trim(x)), lambda x: x <> '')) AS asesor FROM near WHERE trim(asesores_display) <> '') SELECT asesor, count(*) AS n, round(sum(sim * sim), 4) AS score FROM a GROUP BY 1 ORDER BY score DESC, asesor LIMIT 15")
def advisor_rank(spark: SparkSession, d: str) -> DataFrame:
    return _advisors(near(spark, d)).drop("src", "rank").orderBy(F.desc("score"), "asesor")


_ADV = "a AS (SELECT DISTINCT src, id, sim, anio, unnest(list_filter(list_transform(string_split(asesores_display, '|'), lambda x: trim(x)), lambda x: x <> '')) AS asesor FROM near WHERE trim(asesores_display) <> '')"


@entry(f"WITH {_TE}, {_ADV}, g AS (SELECT src, asesor, count(*) AS n, round(sum(sim * sim), 4) AS score FROM a GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, asesor) AS rank FROM g) SELECT src, asesor, n, score, rank FROM r WHERE rank <= 15")
def advisor_rank_each(spark: SparkSession, d: str) -> DataFrame:
    return _advisors(near(spark, d, each=True)).withColumn("rank", F.col("rank").cast("long"))


def _ranked(n: DataFrame) -> DataFrame:
    """(src, rank, asesor, n, sim_max, ultimo, ejemplos): the 15 advisors of most neighbours, then of the nearest one,
    then of the latest year, with the ids of three examples, the nearest first. A query has at most 100 neighbours."""
    a = n.where(~X.missing(F.col("asesores_display"))).select("src", "id", "sim", "anio", F.explode(X.clean_list(F.col("asesores_display"))).alias("asesor"))
    shown = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("s"), "id"))), 1, 3), lambda x: x["id"])
    g = a.groupBy("src", "asesor").agg(F.count("*").alias("n"), F.max("sim").alias("sim_max"), F.coalesce(F.max("anio"), F.lit(0)).alias("ultimo"), shown.alias("ejemplos"))
    return top_per(g, ["src"], 15, F.desc("n"), F.desc("sim_max"), F.desc("ultimo"), F.col("asesor")).withColumn("rank", F.col("rank").cast("long"))


@entry(
    f"WITH {_TE}, {_ADV}, g AS (SELECT src, asesor, count(*) AS n, max(sim) AS sim_max, coalesce(max(anio), 0) AS ultimo, array_to_string(list_slice(list(id ORDER BY sim DESC, id), 1, 3), ',') AS ejemplos FROM a GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY n DESC, sim_max DESC, ultimo DESC, asesor) AS rank FROM g) SELECT src, rank, asesor, n, sim_max, ultimo, ejemplos FROM r WHERE rank <= 15"
)
def context_advisors(spark: SparkSession, d: str) -> DataFrame:
    r = _ranked(near(spark, d, each=True))
    return r.select("src", "rank", "asesor", "n", "sim_max", "ultimo", F.array_join(F.transform("ejemplos", lambda x: x.cast("string")), ",").alias("ejemplos"))


@entry()
def context_document(spark: SparkSession, d: str) -> DataFrame:
    """The whole answer to each query in one row: place (up to four groups, how clear the reading is), saturation by
    decade, the 15 nearest theses, 15 advisors with examples, keyword coverage. The neighbours are searched once."""
    n = near(spark, d, each=True)
    ordered = lambda rows, by, *cols: rows.groupBy("src").agg(F.transform(F.array_sort(F.collect_list(F.struct(by, F.struct(*cols).alias("x")))), lambda p: p["x"]).alias("list"))
    parts = {
        "ubicacion": ordered(V.vote(n.where("cluster >= 0"), ["src"], "cluster", 4), "rank", "cluster", "weight", "share"),
        "saturacion": ordered(_saturation(spark, d, n), "decade", "decade", "n", "per_mille"),
        "cercanas": ordered(n.where("rank <= 15"), "rank", "id", "sim", "titulo_limpio", "anio"),
        "asesores": ordered(_ranked(n), "rank", "asesor", "n", "sim_max", "ultimo", "ejemplos"),
        "palabras": ordered(_keywords(n), "keyword", "keyword", "n"),
    }
    out = _analysis(n)
    for name, rows_ in parts.items():
        out = out.join(rows_.withColumnRenamed("list", name), "src", "left")
    return out


def _saturation(spark: SparkSession, d: str, n: DataFrame) -> DataFrame:
    dec = lambda c: F.expr(f"`{c}` div 10 * 10")
    spine = n.select("src").distinct().select("src", F.explode(F.expr("sequence(1950L, 2020L, 10L)")).alias("decade"))
    a = n.where("anio >= 1950").groupBy("src", dec("anio").alias("decade")).agg(F.count("*").alias("n"))
    b = base(spark, d).where("`año` >= 1950").groupBy(dec("año").alias("decade")).agg(F.count("*").alias("total"))
    j = spine.join(a, ["src", "decade"], "left").join(b, "decade", "left").na.fill(0, ["n"])
    return j.select("src", "decade", "n", F.round(F.try_divide(F.col("n") * 1000.0, "total"), 4).alias("per_mille"))


@entry(f"WITH {_T}, sp AS (SELECT unnest(generate_series(1950, 2020, 10)) AS decade), a AS (SELECT anio // 10 * 10 AS decade, count(*) AS n FROM near WHERE anio >= 1950 GROUP BY 1), b AS (SELECT \"año\" // 10 * 10 AS decade, count(*) AS total FROM base7_kaggle_clean WHERE \"año\" >= 1950 GROUP BY 1) SELECT sp.decade, coalesce(n, 0) AS n, round(coalesce(n, 0) * 1000.0 / nullif(total, 0), 4) AS per_mille FROM sp LEFT JOIN a USING (decade) LEFT JOIN b USING (decade)")
def saturation_by_decade(spark: SparkSession, d: str) -> DataFrame:
    return _saturation(spark, d, near(spark, d)).drop("src")


@entry(f"WITH {_TE}, sp AS (SELECT src, decade FROM (SELECT DISTINCT src FROM near), (SELECT unnest(generate_series(1950, 2020, 10)) AS decade)), a AS (SELECT src, anio // 10 * 10 AS decade, count(*) AS n FROM near WHERE anio >= 1950 GROUP BY 1, 2), b AS (SELECT \"año\" // 10 * 10 AS decade, count(*) AS total FROM base7_kaggle_clean WHERE \"año\" >= 1950 GROUP BY 1) SELECT sp.src, sp.decade, coalesce(n, 0) AS n, round(coalesce(n, 0) * 1000.0 / nullif(total, 0), 4) AS per_mille FROM sp LEFT JOIN a ON a.src = sp.src AND a.decade = sp.decade LEFT JOIN b ON b.decade = sp.decade")
def saturation_by_decade_each(spark: SparkSession, d: str) -> DataFrame:
    return _saturation(spark, d, near(spark, d, each=True))


def _keywords(n: DataFrame) -> DataFrame:
    from lumbrera.operators.textindex import keyword_hits

    return keyword_hits(n, F.col("titulo_limpio"), ["agua", "riego", "estudio", "propuesta", "lectura"], ["src"])


@entry(f"WITH {_T}, kw AS (SELECT unnest(['agua', 'riego', 'estudio', 'propuesta', 'lectura']) AS keyword) SELECT keyword, count(*) FILTER (regexp_matches(translate(lower(coalesce(titulo_limpio, '')), 'áéíóúüñ', 'aeiouun'), '\\b' || keyword || '\\b')) AS n FROM near, kw GROUP BY 1")
def keyword_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _keywords(near(spark, d)).drop("src")


@entry(f"WITH {_TE}, kw AS (SELECT unnest(['agua', 'riego', 'estudio', 'propuesta', 'lectura']) AS keyword) SELECT src, keyword, count(*) FILTER (regexp_matches(translate(lower(coalesce(titulo_limpio, '')), 'áéíóúüñ', 'aeiouun'), '\\b' || keyword || '\\b')) AS n FROM near, kw GROUP BY 1, 2")
def keyword_coverage_each(spark: SparkSession, d: str) -> DataFrame:
    return _keywords(near(spark, d, each=True))


def _preview(n: DataFrame) -> DataFrame:
    return n.where("rank <= 50").select("src", "id", "sim", "rank", "titulo_limpio", "anio", "area", (F.col("cluster") >= 0).alias("in_group"))


@entry(f"WITH {_T} SELECT id, sim, rank, titulo_limpio, anio, area, cluster >= 0 AS in_group FROM near WHERE rank <= 50")
def neighbour_preview(spark: SparkSession, d: str) -> DataFrame:
    return _preview(near(spark, d)).drop("src")


@entry(f"WITH {_TE} SELECT src, id, sim, rank, titulo_limpio, anio, area, cluster >= 0 AS in_group FROM near WHERE rank <= 50")
def neighbour_preview_each(spark: SparkSession, d: str) -> DataFrame:
    return _preview(near(spark, d, each=True))


def _distributions(n: DataFrame) -> DataFrame:
    c = n.where("programa IS NOT NULL").groupBy("src", "programa").agg(F.count("*").alias("n"))
    return top_per(c, ["src"], 10, F.desc("n"), F.col("programa")).select("src", F.col("rank").cast("long").alias("rank"), "programa", "n")


@entry(f"WITH {_T}, c AS (SELECT programa, count(*) AS n FROM near WHERE programa IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, programa) AS k FROM c) SELECT k AS rank, programa, n FROM r WHERE k <= 10")
def context_distributions(spark: SparkSession, d: str) -> DataFrame:
    return _distributions(near(spark, d)).drop("src")


@entry(f"WITH {_TE}, c AS (SELECT src, programa, count(*) AS n FROM near WHERE programa IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY n DESC, programa) AS k FROM c) SELECT src, k AS rank, programa, n FROM r WHERE k <= 10")
def context_distributions_each(spark: SparkSession, d: str) -> DataFrame:
    return _distributions(near(spark, d, each=True))


@entry("SELECT vec_id, round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 4) AS n FROM sample_50k_embeddings WHERE embedding IS NOT NULL")
def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sample_50k_embeddings").where("embedding IS NOT NULL").select("vec_id", F.round(V.norm(F.col("embedding")), 4).alias("n"))


QUERIES = queries_of(globals())
