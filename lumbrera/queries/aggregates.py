"""Aggregations, windows and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.functions import text as X
from lumbrera.operators import profile as A
from lumbrera.operators import relational as R
from lumbrera.queries import base, entry, queries_of, table


@entry("SELECT count(*) AS n, min(\"año\") AS lo, max(\"año\") AS hi, count(DISTINCT thesis_id) AS ids, count(nullif(trim(asesor_limpio_v2), '')) AS with_advisor FROM base7_kaggle_clean")
def table_totals(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).agg(F.count("*").alias("n"), F.min("año").alias("lo"), F.max("año").alias("hi"), F.count_distinct("thesis_id").alias("ids"), F.count(X.nonempty(F.col("asesor_limpio_v2"))).alias("with_advisor"))


@entry('SELECT "año" AS anio, nivel_estandar, area, count(*) AS n FROM base7_kaggle_clean GROUP BY 1, 2, 3')
def year_counts(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).groupBy(F.col("año").alias("anio"), "nivel_estandar", "area").agg(F.count("*").alias("n"))


@entry("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def null_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@entry("WITH g AS (SELECT plantel_display, count(*) AS n, count(DISTINCT programa) AS programs, sum(num_autores) AS authors FROM base7_kaggle_clean GROUP BY 1) SELECT count(*) AS groups, min(n) AS lo, median(n) AS med, max(n) AS hi, CAST(sum(programs) AS BIGINT) AS programs, CAST(sum(authors) AS BIGINT) AS authors FROM g")
def two_level(spark: SparkSession, d: str) -> DataFrame:
    g = base(spark, d).groupBy("plantel_display").agg(F.count("*").alias("n"), F.count_distinct("programa").alias("programs"), F.sum("num_autores").alias("authors"))
    return g.agg(F.count("*").alias("groups"), F.min("n").alias("lo"), F.median("n").alias("med"), F.max("n").alias("hi"), F.sum("programs").alias("programs"), F.sum("authors").alias("authors"))


@entry("SELECT target_year, count(*) AS n, count(*) FILTER (coalesce(trim(texto_completo_url), '') <> '') AS with_url, count(*) FILTER (coalesce(trim(error), '') <> '') AS failed, round(count(*) FILTER (coalesce(trim(texto_completo_url), '') <> '') * 100.0 / count(*), 4) AS url_pct FROM marc_status_log GROUP BY 1")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    url = ~X.missing(F.col("texto_completo_url"))
    g = table(spark, d, "marc_status_log").groupBy("target_year").agg(F.count("*").alias("n"), F.count_if(url).alias("with_url"), F.count_if(~X.missing(F.col("error"))).alias("failed"))
    return g.withColumn("url_pct", F.round(F.col("with_url") * 100.0 / F.col("n"), 4))


@entry(
    "WITH c AS (SELECT plantel_display, area, count(*) AS n FROM base7_kaggle_clean WHERE area IS NOT NULL GROUP BY 1, 2), m AS (SELECT plantel_display, area AS mode_area, row_number() OVER (PARTITION BY plantel_display ORDER BY n DESC, area) AS r FROM c), "
    "s AS (SELECT plantel_display, list_sort(list(DISTINCT nivel_estandar)) AS levels FROM base7_kaggle_clean GROUP BY 1) SELECT s.plantel_display, mode_area, array_to_string(levels, ',') AS levels FROM s JOIN m ON s.plantel_display = m.plantel_display WHERE r = 1"
)
def mode_and_set(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).where("plantel_display IS NOT NULL")
    mode = R.share_dominant(b, ["plantel_display"], "area").select("plantel_display", F.col("dominant").alias("mode_area"))
    levels = b.groupBy("plantel_display").agg(F.array_join(F.array_sort(F.collect_set("nivel_estandar")), ",").alias("levels"))
    return levels.join(mode, "plantel_display").select("plantel_display", "mode_area", "levels")


@entry(
    "WITH c AS (SELECT cluster, area, count(*) AS c FROM sample_50k_embeddings JOIN base7_kaggle_clean USING (thesis_id) WHERE area IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, sum(c) OVER (PARTITION BY cluster) AS n, row_number() OVER (PARTITION BY cluster ORDER BY c DESC, area) AS k FROM c) "
    "SELECT cluster, CAST(n AS BIGINT) AS n, area AS dominant, round(c / n, 6) AS share FROM r WHERE k = 1"
)
def share_dominant(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "sample_50k_embeddings").select("thesis_id", "cluster").join(base(spark, d).select("thesis_id", "area"), "thesis_id")
    return R.share_dominant(v, ["cluster"], "area").withColumn("share", F.round("share", 6))


@entry(
    "WITH c AS (SELECT plantel_estandarizado AS k, plantel_display AS v, count(*) AS c FROM base7_kaggle_clean WHERE plantel_display IS NOT NULL AND plantel_estandarizado IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, sum(c) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY c DESC, v) AS rk FROM c) "
    "SELECT k AS plantel_estandarizado, CAST(n AS BIGINT) AS n, v AS canonical, round(c / n, 6) AS share, c / n >= 0.9 AS decided FROM r WHERE rk = 1"
)
def majority_canonical(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).where("plantel_estandarizado IS NOT NULL")
    return R.majority(b, "plantel_estandarizado", "plantel_display", 0.9).withColumn("share", F.round("share", 6))


_UNACC = "translate(lower({c}), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc')"


@entry(
    f"WITH c AS (SELECT trim(programa) AS v, {_UNACC.format(c='trim(programa)')} AS k, count(*) AS n FROM base7_kaggle_clean WHERE trim(programa) <> '' GROUP BY 1, 2), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY (v = k) DESC, n DESC, v) AS rk FROM c) SELECT k, v AS canonical, n FROM r WHERE rk = 1"
)
def convention_canonical(spark: SparkSession, d: str) -> DataFrame:
    v = F.trim("programa")
    c = base(spark, d).where(v != "").groupBy(v.alias("v"), X.unaccent(F.lower(v)).alias("k")).agg(F.count("*").alias("n"))
    return R.keep_first(c, ["k"], F.desc(F.col("v") == F.col("k")), F.desc("n"), F.col("v")).select("k", F.col("v").alias("canonical"), "n")


@entry("WITH c AS (SELECT area, programa, count(*) AS c FROM base7_kaggle_clean GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY c DESC, programa) AS k FROM c) SELECT area, string_agg(programa || ' (' || c || ')', ' | ' ORDER BY k) AS top FROM r WHERE k <= 4 GROUP BY area")
def topn_string(spark: SparkSession, d: str) -> DataFrame:
    return R.top_string(base(spark, d), "area", "programa", 4)


@entry("SELECT macroid, round(median(CAST(position.x AS DOUBLE)), 4) AS x, round(median(CAST(position.y AS DOUBLE)), 4) AS y, count(*) AS n FROM cluster_nodes_final_50k GROUP BY 1")
def median_position(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "cluster_nodes_final_50k")
    return n.groupBy("macroid").agg(F.round(F.median(F.col("position.x").cast("double")), 4).alias("x"), F.round(F.median(F.col("position.y").cast("double")), 4).alias("y"), F.count("*").alias("n"))


@entry(
    "WITH t AS (SELECT origen, nivel_estandar AS v, count(*) AS n FROM base7_kaggle_clean GROUP BY 1, 2), s AS (SELECT origen, sum(n) AS total FROM t WHERE v IN ('licenciatura', 'maestria', 'doctorado') GROUP BY 1) SELECT t.origen, round(coalesce(sum(n) FILTER (v = 'licenciatura'), 0) / any_value(total), 4) AS licenciatura, "
    "round(coalesce(sum(n) FILTER (v = 'maestria'), 0) / any_value(total), 4) AS maestria, round(coalesce(sum(n) FILTER (v = 'doctorado'), 0) / any_value(total), 4) AS doctorado FROM t LEFT JOIN s ON t.origen IS NOT DISTINCT FROM s.origen GROUP BY 1"
)
def crosstab_shares(spark: SparkSession, d: str) -> DataFrame:
    return A.crosstab_share(base(spark, d), "origen", "nivel_estandar", ["licenciatura", "maestria", "doctorado"])


@entry(
    "WITH c AS (SELECT origen, nivel_estandar, count(*) AS n FROM base7_kaggle_clean GROUP BY 1, 2), t AS (SELECT origen, sum(n) AS total FROM c GROUP BY 1), v AS (SELECT DISTINCT nivel_estandar FROM c) SELECT t.origen, v.nivel_estandar, coalesce(n, 0) AS n, round(coalesce(n, 0) / total, 4) AS share "
    "FROM t CROSS JOIN v LEFT JOIN c ON c.origen IS NOT DISTINCT FROM t.origen AND c.nivel_estandar IS NOT DISTINCT FROM v.nivel_estandar"
)
def crosstab_shares_whole(spark: SparkSession, d: str) -> DataFrame:
    """Shares of all levels, where crosstab_shares has the three that its SQL names."""
    return A.crosstab_long(base(spark, d), "origen", "nivel_estandar")


@entry("SELECT target_year, count(*) FILTER (download_status = 'success_metadata') AS success_metadata, count(*) FILTER (download_status = 'failed') AS failed FROM marc_status_log GROUP BY 1")
def pivot_year_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "marc_status_log").groupBy("target_year").pivot("download_status", ["success_metadata", "failed"]).agg(F.count(F.lit(1))).na.fill(0, ["success_metadata", "failed"])


_COV = (
    "source_record", "thesis_id", "thesis_id_old", "id_aleph", "biblionumber", "system_number", "año", "título", "titulo_limpio", "titulo_normalizado", "autores_limpios_v2", "autor_limpio_v2", "autores_display", "autor_display", "autor_ui",
    "num_autores", "flag_sin_autor", "flag_multiples_autores", "asesores_limpios_v2", "asesor_limpio_v2", "asesores_display", "asesor_display", "asesor_ui", "num_asesores", "flag_sin_asesor", "flag_multiples_asesores", "grado", "grado_norm",
    "nivel_estandar", "programa", "area", "origen", "universidad_nota", "entidad_clean", "plantel_estandarizado", "plantel_display", "texto_completo_url", "restricciones", "tipo de contenido", "medio", "soporte", "descr física", "materia general",
)


@entry(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS total, count(nullif(trim(CAST(\"{c}\" AS VARCHAR)), '')) AS non_empty, round(count(nullif(trim(CAST(\"{c}\" AS VARCHAR)), '')) * 100.0 / count(*), 4) AS pct, count(DISTINCT nullif(trim(CAST(\"{c}\" AS VARCHAR)), '')) AS distinct_values FROM base7_kaggle_clean" for c in _COV))
def cov_profile(spark: SparkSession, d: str) -> DataFrame:
    return A.coverage(base(spark, d), _COV)


@entry("WITH p AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS total, count(nullif(trim(CAST(\"{c}\" AS VARCHAR)), '')) * 100.0 / count(*) AS pct, count(DISTINCT nullif(trim(CAST(\"{c}\" AS VARCHAR)), '')) AS dv FROM base7_kaggle_clean" for c in _COV) + ") SELECT \"column\", CASE WHEN pct = 0 THEN 'eliminar' WHEN dv = total THEN 'llave' WHEN pct < 5 THEN 'archivar' WHEN dv <= 50 THEN 'categoria' ELSE 'conservar' END AS decision FROM p")
def column_decisions(spark: SparkSession, d: str) -> DataFrame:
    return A.coverage(base(spark, d), _COV).select("column", A.column_decision(F.col("pct"), F.col("distinct_values"), F.col("total")).alias("decision"))


@entry()
def cov_profile_whole(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of every column, where cov_profile has the twelve that its SQL names."""
    return A.coverage(base(spark, d))


@entry()
def column_decisions_whole(spark: SparkSession, d: str) -> DataFrame:
    """The decision on every column, where column_decisions has the twelve that its SQL names."""
    return A.coverage(base(spark, d)).select("column", A.column_decision(F.col("pct"), F.col("distinct_values"), F.col("total")).alias("decision"))


@entry(f"SELECT programa AS \"before\", {_UNACC.format(c='trim(programa)')} AS \"after\", count(*) AS n FROM base7_kaggle_clean WHERE programa IS DISTINCT FROM {_UNACC.format(c='trim(programa)')} GROUP BY 1, 2")
def change_summary(spark: SparkSession, d: str) -> DataFrame:
    return A.changes(base(spark, d), F.col("programa"), X.unaccent(F.lower(F.trim("programa"))))


@entry("SELECT programa, count(DISTINCT area) AS effects FROM base7_kaggle_clean GROUP BY 1 HAVING count(DISTINCT area) > 1")
def determinism_check(spark: SparkSession, d: str) -> DataFrame:
    return A.undetermined(base(spark, d), "programa", "area")


@entry("WITH g AS (SELECT titulo_normalizado AS k, count(*) AS n FROM base7_kaggle_clean GROUP BY 1) SELECT round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n), 6) AS rate FROM g")
def dup_rate(spark: SparkSession, d: str) -> DataFrame:
    return A.duplicate_rate(base(spark, d), F.col("titulo_normalizado")).select(F.round("rate", 6).alias("rate"))


_FLAG_SQL = {"sin_coma": "^[^,]+$", "con_digitos": "\\d", "con_parentesis": "[()]", "con_punto_final": "\\.$", "doble_espacio": "\\s{2,}", "minusculas": "^[^A-ZÁÉÍÓÚÑÜ]+$", "mayusculas": "^[^a-záéíóúñü]+$", "una_palabra": "^\\S+$", "titulo": "(?i)\\b(dra?|mtr[oa]|lic|ing|prof)\\.", "varias_comas": ",.*,", "signo_raro": "[^\\p{{L}}\\s,.''()\\d-]".replace("{{", "{").replace("}}", "}")}


@entry("WITH n AS (SELECT unnest(list_distinct(list_filter(list_transform(string_split(coalesce(asesores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> ''))) AS name FROM base7_kaggle_clean) " + " UNION ALL ".join(f"SELECT '{k}' AS flag, count(*) FILTER (regexp_matches(name, '{p}')) AS n, count(*) AS total FROM n" for k, p in _FLAG_SQL.items()))
def flag_summary(spark: SparkSession, d: str) -> DataFrame:
    return A.flag_summary(base(spark, d), X.clean_list(F.col("asesores_display")))


@entry(f"SELECT {_UNACC.format(c='trim(programa)')} AS k, count(DISTINCT programa) AS variants, string_agg(DISTINCT programa, ' | ' ORDER BY programa) AS examples FROM base7_kaggle_clean WHERE programa IS NOT NULL GROUP BY 1 HAVING count(DISTINCT programa) > 1")
def key_variants(spark: SparkSession, d: str) -> DataFrame:
    g = base(spark, d).where("programa IS NOT NULL").select("programa").distinct().groupBy(X.unaccent(F.lower(F.trim("programa"))).alias("k"))
    return g.agg(F.count("*").alias("variants"), F.array_join(F.array_sort(F.collect_list("programa")), " | ").alias("examples")).where("variants > 1")


@entry("WITH y AS (SELECT \"año\" AS anio, count(*) AS n FROM base7_kaggle_clean WHERE \"año\" > 0 GROUP BY 1), s AS (SELECT unnest(generate_series((SELECT min(anio) FROM y), (SELECT max(anio) FROM y))) AS anio), f AS (SELECT s.anio, coalesce(n, 0) AS n FROM s LEFT JOIN y ON y.anio = s.anio), w AS (SELECT anio, n, lag(n) OVER (ORDER BY anio) AS prev, avg(n) OVER (ORDER BY anio ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM f) SELECT anio, n, n - prev AS diff, round((n - prev) / nullif(prev, 0), 4) AS pct, round(m, 4) AS mean5, coalesce((n - prev) / nullif(prev, 0) <= -0.35 AND n - prev <= -3, false) AS fall FROM w")
def year_drop_audit(spark: SparkSession, d: str) -> DataFrame:
    y = base(spark, d).where("`año` > 0").groupBy(F.col("año").alias("anio")).agg(F.count("*").alias("n"))
    s = R.drops(R.year_spine(y, "anio", "n"), "anio", "n", least=-3)
    return s.select("anio", "n", "diff", F.round("pct", 4).alias("pct"), F.round("mean5", 4).alias("mean5"), "fall")


@entry(
    "WITH l AS (SELECT biblionumber, target_year, arg_max(download_status, log_seq) AS st, arg_max(coalesce(trim(texto_completo_url), '') <> '', log_seq) AS url FROM marc_status_log WHERE biblionumber IS NOT NULL GROUP BY 1, 2), m AS (SELECT target_year, count(DISTINCT biblionumber) AS listed FROM marc_year_manifest WHERE biblionumber <> '' GROUP BY 1), "
    "c AS (SELECT target_year, count(*) FILTER (st = 'success_metadata') AS ok, count(*) FILTER (st = 'failed') AS failed, count(*) FILTER (url) AS urls, count(*) AS done FROM l GROUP BY 1) SELECT m.target_year, listed, coalesce(ok, 0) AS ok, coalesce(failed, 0) AS failed, greatest(listed - coalesce(ok, 0), 0) AS remaining, round(coalesce(urls * 100.0 / nullif(done, 0), 0), 4) AS url_pct FROM m LEFT JOIN c ON m.target_year IS NOT DISTINCT FROM c.target_year"
)
def download_progress(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "marc_status_log").where("biblionumber IS NOT NULL")
    last = log.groupBy("biblionumber", "target_year").agg(F.max_by("download_status", "log_seq").alias("st"), F.max_by(~X.missing(F.col("texto_completo_url")), F.col("log_seq")).alias("url"))
    c = last.groupBy(F.col("target_year").alias("y")).agg(F.count_if(F.col("st") == "success_metadata").alias("ok"), F.count_if(F.col("st") == "failed").alias("failed"), F.count_if("url").alias("urls"), F.count("*").alias("done"))
    m = table(spark, d, "marc_year_manifest").where("biblionumber <> ''").groupBy("target_year").agg(F.count_distinct("biblionumber").alias("listed"))
    j = m.join(c, m["target_year"].eqNullSafe(c["y"]), "left").na.fill(0, ["ok", "failed", "urls", "done"])
    return j.select("target_year", "listed", "ok", "failed", F.greatest(F.col("listed") - F.col("ok"), F.lit(0)).alias("remaining"), F.round(F.coalesce(F.try_divide(F.col("urls") * 100.0, "done"), F.lit(0.0)), 4).alias("url_pct"))


@entry(
    "WITH a AS (SELECT \"año\" AS y, count(*) FILTER (source_record = 'base6') AS base_n, count(*) FILTER (source_record <> 'base6') AS marc_n FROM base7_kaggle_clean GROUP BY 1) SELECT y, base_n, marc_n, marc_n - base_n AS delta, CASE WHEN marc_n = 0 THEN 'conservar' WHEN base_n = 0 THEN 'agregar' WHEN marc_n > base_n THEN 'reemplazar' ELSE 'conservar' END AS action FROM a"
)
def merge_plan(spark: SparkSession, d: str) -> DataFrame:
    a = base(spark, d).groupBy(F.col("año").alias("y")).agg(F.count_if(F.col("source_record") == "base6").alias("base_n"), F.count_if(F.col("source_record") != "base6").alias("marc_n"))
    act = F.when(F.col("marc_n") == 0, "conservar").when(F.col("base_n") == 0, "agregar").when(F.col("marc_n") > F.col("base_n"), "reemplazar").otherwise("conservar")
    return a.select("y", "base_n", "marc_n", (F.col("marc_n") - F.col("base_n")).alias("delta"), act.alias("action"))


@entry("SELECT thesis_id, programa, count(*) OVER (PARTITION BY programa) AS n FROM base7_kaggle_clean")
def transform_size(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).select("thesis_id", "programa")
    n = b.groupBy(F.col("programa").alias("p")).agg(F.count("*").alias("n"))  # joined back: a window would put a hot group in one task
    return b.join(n, F.col("programa").eqNullSafe(F.col("p"))).select("thesis_id", "programa", "n")


@entry("WITH c AS (SELECT area, nivel_estandar AS v, count(*) AS n FROM base7_kaggle_clean GROUP BY 1, 2) SELECT area, v, n, round(n / sum(n) OVER (PARTITION BY area), 6) AS share FROM c")
def group_share(spark: SparkSession, d: str) -> DataFrame:
    c = base(spark, d).groupBy("area", F.col("nivel_estandar").alias("v")).agg(F.count("*").alias("n"))
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("area")), 6))


@entry("WITH p AS (SELECT macroid, clusterid, max(size) AS n FROM cluster_nodes_final_50k WHERE clusterid IS NOT NULL AND size IS NOT NULL GROUP BY 1, 2) SELECT macroid, clusterid, n, CAST(sum(n) OVER (PARTITION BY macroid ORDER BY clusterid) - n AS BIGINT) AS offset_ FROM p")
def csr_offsets(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "cluster_nodes_final_50k").where("clusterid IS NOT NULL AND size IS NOT NULL").groupBy("macroid", "clusterid").agg(F.max("size").alias("n"))
    return p.withColumn("offset_", (F.sum("n").over(Window.partitionBy("macroid").orderBy("clusterid")) - F.col("n")).cast("long"))


@entry("SELECT programa, round(count(*) FILTER (\"año\" >= 2010) / (SELECT count(*) FILTER (\"año\" >= 2010) FROM base7_kaggle_clean), 6) AS inside_share, round(count(*) / (SELECT count(*) FROM base7_kaggle_clean), 6) AS global_share, round((count(*) FILTER (\"año\" >= 2010) / (SELECT count(*) FILTER (\"año\" >= 2010) FROM base7_kaggle_clean)) / (count(*) / (SELECT count(*) FROM base7_kaggle_clean)), 4) AS ratio FROM base7_kaggle_clean GROUP BY 1")
def enrichment_ratio(spark: SparkSession, d: str) -> DataFrame:
    return A.enrichment(base(spark, d), F.col("año") >= 2010, "programa")


@entry("SELECT count(n_chars) AS n, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS sd, min(n_chars) AS lo, max(n_chars) AS hi, round(quantile_cont(n_chars, 0.5), 4) AS med FROM documents")
def describe_numbers(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("n_chars")
    return table(spark, d, "documents").agg(F.count(c).alias("n"), F.round(F.avg(c), 4).alias("mean"), F.round(F.stddev_samp(c), 4).alias("sd"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.round(F.median(c), 4).alias("med"))


@entry(
    "WITH v AS (SELECT cluster, \"año\" AS y FROM sample_50k_embeddings JOIN base7_kaggle_clean USING (thesis_id) WHERE \"año\" > 0) SELECT cluster, min(y) AS lo, max(y) AS hi, median(y) AS med, round(count(*) FILTER (y >= 2020) / count(*), 4) AS since2020, round(count(*) FILTER (y >= 2000) / count(*), 4) AS since2000, CASE WHEN count(*) FILTER (y >= 2020) / count(*) >= 0.5 THEN 'reciente' WHEN max(y) - min(y) >= 40 THEN 'larga' ELSE 'media' END AS depth FROM v GROUP BY 1"
)
def temporal_pattern(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "sample_50k_embeddings").select("thesis_id", "cluster").join(base(spark, d).select("thesis_id", F.col("año").alias("y")).where("y > 0"), "thesis_id")
    g = v.groupBy("cluster").agg(F.min("y").alias("lo"), F.max("y").alias("hi"), F.median("y").alias("med"), (F.count_if(F.col("y") >= 2020) / F.count("*")).alias("a"), (F.count_if(F.col("y") >= 2000) / F.count("*")).alias("b"))
    depth = F.when(F.col("a") >= 0.5, "reciente").when(F.col("hi") - F.col("lo") >= 40, "larga").otherwise("media")
    return g.select("cluster", "lo", "hi", "med", F.round("a", 4).alias("since2020"), F.round("b", 4).alias("since2000"), depth.alias("depth"))


@entry("WITH e AS (SELECT quantile_disc(n_chars, 0.005) AS lo, quantile_disc(n_chars, 0.995) AS hi FROM documents WHERE n_chars IS NOT NULL) SELECT doc_id, CAST(floor((greatest(least(n_chars, hi), lo) - lo) / nullif(hi - lo, 0) * 1000 + 0.5) AS BIGINT) AS q FROM documents, e WHERE n_chars IS NOT NULL")
def percentile_clamp(spark: SparkSession, d: str) -> DataFrame:
    return A.quantised(table(spark, d, "documents").where("n_chars IS NOT NULL").select("doc_id", "n_chars"), "n_chars").select("doc_id", F.col("q").cast("long").alias("q"))


@entry(
    "WITH a AS (SELECT DISTINCT thesis_id, unnest(list_filter(list_transform(string_split(asesores_display, '|'), lambda x: trim(x)), lambda x: x <> '')) AS asesor, \"año\" AS y, plantel_display, area FROM base7_kaggle_clean WHERE trim(asesores_display) <> ''), m AS (SELECT asesor, area, row_number() OVER (PARTITION BY asesor ORDER BY count(*) DESC, area) AS r FROM a WHERE area IS NOT NULL GROUP BY 1, 2) "
    "SELECT a.asesor, count(*) AS total, max(y) AS last_year, any_value(m.area) AS area FROM a LEFT JOIN m ON m.asesor = a.asesor AND m.r = 1 GROUP BY 1"
)
def advisor_stats(spark: SparkSession, d: str) -> DataFrame:
    a = base(spark, d).where(~X.missing(F.col("asesores_display"))).select("thesis_id", F.explode(X.clean_list(F.col("asesores_display"))).alias("asesor"), F.col("año").alias("y"), "area")
    mode = R.share_dominant(a, ["asesor"], "area").select("asesor", F.col("dominant").alias("area"))
    return a.groupBy("asesor").agg(F.count("*").alias("total"), F.max("y").alias("last_year")).join(mode, "asesor", "left")


@entry(
    "WITH a AS (SELECT DISTINCT thesis_id, unnest(list_filter(list_transform(string_split(asesores_display, '|'), lambda x: trim(x)), lambda x: x <> '')) AS asesor, \"año\" AS y FROM base7_kaggle_clean WHERE trim(asesores_display) <> ''), c AS (SELECT asesor, y, count(*) AS n FROM a GROUP BY 1, 2) SELECT asesor, string_agg(y || ':' || n, ',' ORDER BY y) AS per_year FROM c GROUP BY 1"
)
def advisor_years(spark: SparkSession, d: str) -> DataFrame:
    a = base(spark, d).where(~X.missing(F.col("asesores_display"))).select("thesis_id", F.explode(X.clean_list(F.col("asesores_display"))).alias("asesor"), F.col("año").alias("y"))
    c = a.groupBy("asesor", "y").agg(F.count("*").alias("n"))
    years = F.map_from_entries(F.array_sort(F.collect_list(F.struct("y", "n"))))
    return c.groupBy("asesor").agg(years.alias("m")).select("asesor", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))), ",").alias("per_year"))


QUERIES = queries_of(globals())
