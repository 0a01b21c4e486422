"""Projections, filters, joins and set operations over the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.functions import text as X
from lumbrera.operators import relational as R
from lumbrera.operators.edits import near_texts
from lumbrera.queries import base, entry, queries_of, table

PUBLIC = {
    "thesis_id": "thesis_id", "año": "anio", "titulo_limpio": "titulo_legible", "num_autores": "num_autores", "asesor_ui": "asesor", "asesores_display": "asesores", "num_asesores": "num_asesores", "grado": "grado",
    "grado_norm": "grado_busqueda", "nivel_estandar": "nivel", "programa": "programa", "area": "area", "origen": "origen", "universidad_nota": "universidad", "plantel_display": "plantel", "restricciones": "restricciones",
    "tipo de contenido": "tipo_contenido", "medio": "medio", "soporte": "soporte", "descr física": "descripcion_fisica", "materia general": "materias",
}


@entry('SELECT thesis_id, "año" AS anio, titulo_limpio AS titulo_legible, num_autores, asesor_ui AS asesor, asesores_display AS asesores, num_asesores, grado, grado_norm AS grado_busqueda, nivel_estandar AS nivel, programa, area, origen, universidad_nota AS universidad, plantel_display AS plantel, restricciones, "tipo de contenido" AS tipo_contenido, medio, soporte, "descr física" AS descripcion_fisica, "materia general" AS materias FROM base7_kaggle_clean')
def public_table(spark: SparkSession, d: str) -> DataFrame:
    return R.project(base(spark, d), PUBLIC)


@entry("SELECT thesis_id, programa, area FROM base7_kaggle_clean")
def available_columns(spark: SparkSession, d: str) -> DataFrame:
    return R.available(base(spark, d), ["thesis_id", "no_such_column", "programa", "area"])


@entry("SELECT column_name AS name, ordinal AS position FROM (SELECT column_name, CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal FROM (DESCRIBE SELECT * FROM base7_kaggle_clean))")
def schema_fields(spark: SparkSession, d: str) -> DataFrame:
    fields = base(spark, d).schema.fields
    return spark.createDataFrame([(f.name, k) for k, f in enumerate(fields)], "name string, position int")


@entry("SELECT thesis_id, \"año\" AS anio FROM base7_kaggle_clean ORDER BY md5(thesis_id || '42'), thesis_id LIMIT 100")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).orderBy(F.md5(F.concat("thesis_id", F.lit("42"))), "thesis_id").limit(100).select("thesis_id", F.col("año").alias("anio"))


@entry("SELECT coalesce(manifest_status, '') AS manifest_status, coalesce(target_year, 0) AS target_year, coalesce(biblionumber, '') AS biblionumber, false AS flag_nuevo, CAST(NULL AS DOUBLE) AS bajado_unix FROM marc_year_manifest")
def conform_schema(spark: SparkSession, d: str) -> DataFrame:
    schema = {"manifest_status": "string", "target_year": "bigint", "biblionumber": "string", "flag_nuevo": "boolean", "bajado_unix": "double"}
    return R.conform(table(spark, d, "marc_year_manifest"), schema)


@entry("SELECT thesis_id, entidad_clean FROM base7_kaggle_clean WHERE nullif(trim(entidad_clean), '') IS NOT NULL")
def archive_column(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where(~X.missing(F.col("entidad_clean"))).select("thesis_id", "entidad_clean")


@entry("SELECT thesis_id, \"año\" AS anio, nivel_estandar FROM base7_kaggle_clean WHERE \"año\" IN (1998, 2003, 2004, 2010) AND nivel_estandar NOT IN ('maestria')")
def in_list(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where(F.col("año").isin(1998, 2003, 2004, 2010) & ~F.col("nivel_estandar").isin("maestria")).select("thesis_id", F.col("año").alias("anio"), "nivel_estandar")


@entry("SELECT thesis_id, titulo_limpio FROM base7_kaggle_clean WHERE lower(titulo_limpio) LIKE '%agua%' OR lower(titulo_limpio) LIKE '%riego%'")
def like_any(spark: SparkSession, d: str) -> DataFrame:
    t = F.lower("titulo_limpio")
    return base(spark, d).where(t.like("%agua%") | t.like("%riego%")).select("thesis_id", "titulo_limpio")


@entry('SELECT thesis_id, num_autores, num_asesores FROM base7_kaggle_clean WHERE num_autores > 1 AND num_asesores >= 2 AND "año" > 0')
def compare_counts(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where((F.col("num_autores") > 1) & (F.col("num_asesores") >= 2) & (F.col("año") > 0)).select("thesis_id", "num_autores", "num_asesores")


@entry("SELECT thesis_id, biblionumber FROM base7_kaggle_clean WHERE biblionumber IS NOT NULL AND titulo_limpio IS NOT NULL")
def not_null(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where(F.col("biblionumber").isNotNull() & F.col("titulo_limpio").isNotNull()).select("thesis_id", "biblionumber")


@entry("SELECT thesis_id, titulo_limpio FROM base7_kaggle_clean WHERE regexp_matches(titulo_limpio, '(?i)(estudio|propuesta) (de|para)')")
def regex_contains(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where(F.col("titulo_limpio").rlike(r"(?i)(estudio|propuesta) (de|para)")).select("thesis_id", "titulo_limpio")


@entry(
    "WITH p AS (SELECT DISTINCT id, CAST(position.x AS DOUBLE) AS x, CAST(position.y AS DOUBLE) AS y FROM cluster_nodes_final_50k), m AS (SELECT median(x) AS mx, median(y) AS my FROM p), b AS (SELECT median(x) AS bx, median(y) AS by_ FROM p WHERE x > 2 AND y > 0) "
    "SELECT id, round(CASE WHEN x > 2 AND y > 0 THEN x + (mx - bx) ELSE x END, 4) AS x, round(CASE WHEN x > 2 AND y > 0 THEN y + (my - by_) ELSE y END, 4) AS y FROM p, m, b"
)
def shift_box(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "cluster_nodes_final_50k").select("id", F.col("position.x").cast("double").alias("x"), F.col("position.y").cast("double").alias("y")).distinct()
    inside = (F.col("x") > 2) & (F.col("y") > 0)
    mid = p.agg(F.median("x").alias("mx"), F.median("y").alias("my"), F.median(F.when(inside, F.col("x"))).alias("bx"), F.median(F.when(inside, F.col("y"))).alias("by"))
    q = p.crossJoin(F.broadcast(mid))  # one row
    return q.select("id", F.round(F.when(inside, F.col("x") + F.col("mx") - F.col("bx")).otherwise(F.col("x")), 4).alias("x"), F.round(F.when(inside, F.col("y") + F.col("my") - F.col("by")).otherwise(F.col("y")), 4).alias("y"))


@entry("SELECT thesis_id, CASE WHEN origen = 'ficha escaneada' AND coalesce(trim(restricciones), '') = '' THEN 'por revisar' ELSE coalesce(restricciones, '') END AS restricciones FROM base7_kaggle_clean")
def masked_update(spark: SparkSession, d: str) -> DataFrame:
    mask = (F.col("origen") == "ficha escaneada") & X.missing(F.col("restricciones"))
    return base(spark, d).select("thesis_id", F.when(mask, "por revisar").otherwise(F.coalesce("restricciones", F.lit(""))).alias("restricciones"))


@entry("SELECT thesis_id, coalesce(nullif(trim(asesor_limpio_v2), ''), nullif(trim(asesor_display), ''), nullif(trim(asesor_ui), ''), 'sin asesor') AS asesor FROM base7_kaggle_clean")
def fallback(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", F.coalesce(X.first_nonempty(F.col("asesor_limpio_v2"), F.col("asesor_display"), F.col("asesor_ui")), F.lit("sin asesor")).alias("asesor"))


_RICH = "struct_pack(names := len(list_filter(list_transform(string_split({c}, '|'), lambda x: trim(x)), lambda x: x <> '')), seps := len(string_split({c}, '|')) - 1, l := length({c}), pos := {k}, value := {c}, source := '{n}')"
_RICH_COLS = ("autores_limpios_v2", "autores_display", "autor_limpio_v2")


@entry(
    "WITH t AS (SELECT thesis_id, " + ", ".join(f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g')) AS {c}" for c in _RICH_COLS) + " FROM base7_kaggle_clean), u AS (SELECT thesis_id, list_max([" + ", ".join(_RICH.format(c=c, n=c, k=-k) for k, c in enumerate(_RICH_COLS)) + "]) AS b FROM t) SELECT thesis_id, b.value AS value, b.source AS source FROM u"
)
def richest_column(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", R.richest(_RICH_COLS).alias("b")).select("thesis_id", "b.value", "b.source")


@entry(
    "SELECT thesis_id, CASE WHEN coalesce(trim(plantel_estandarizado), '') <> '' THEN plantel_estandarizado WHEN lower(coalesce(universidad_nota, '')) LIKE '%facultad%' THEN universidad_nota WHEN coalesce(trim(entidad_clean), '') <> '' THEN entidad_clean WHEN regexp_extract(lower(coalesce(grado, '')), '(licenciatura|maestria|doctorado)') <> '' THEN regexp_extract(lower(grado), '(licenciatura|maestria|doctorado)') ELSE 'no especificado' END AS valor, "
    "CASE WHEN coalesce(trim(plantel_estandarizado), '') <> '' THEN 'explicito' WHEN lower(coalesce(universidad_nota, '')) LIKE '%facultad%' THEN 'nota' WHEN coalesce(trim(entidad_clean), '') <> '' THEN 'entidad' WHEN regexp_extract(lower(coalesce(grado, '')), '(licenciatura|maestria|doctorado)') <> '' THEN 'extraccion' ELSE 'sin dato' END AS metodo FROM base7_kaggle_clean"
)
def rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    word = F.regexp_extract(F.lower(F.coalesce("grado", F.lit(""))), "(licenciatura|maestria|doctorado)", 1)
    pair = lambda v, m: F.struct(v.alias("valor"), F.lit(m).alias("metodo"))
    rule = F.when(~X.missing(F.col("plantel_estandarizado")), pair(F.col("plantel_estandarizado"), "explicito")).when(F.lower("universidad_nota").contains("facultad"), pair(F.col("universidad_nota"), "nota"))
    rule = rule.when(~X.missing(F.col("entidad_clean")), pair(F.col("entidad_clean"), "entidad")).when(word != "", pair(word, "extraccion")).otherwise(pair(F.lit("no especificado"), "sin dato"))
    return base(spark, d).select("thesis_id", rule.alias("r")).select("thesis_id", "r.valor", "r.metodo")


@entry("SELECT thesis_id, asesores_limpios_v2 FROM base7_kaggle_clean WHERE trim(asesores_limpios_v2) <> '' AND trim(asesor_limpio_v2) <> '' AND length(asesor_limpio_v2) + 5 < length(asesores_limpios_v2) AND (contains(asesores_limpios_v2, asesor_limpio_v2) OR ends_with(asesores_limpios_v2, asesor_limpio_v2))")
def suspicious_truncation(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("asesores_limpios_v2"), F.col("asesor_limpio_v2")
    return base(spark, d).where(~X.missing(a) & ~X.missing(b) & (F.length(b) + 5 < F.length(a)) & (a.contains(b) | a.endswith(b))).select("thesis_id", "asesores_limpios_v2")


@entry("SELECT b.thesis_id, coalesce(c.plantel_display, b.plantel_estandarizado) AS plantel, c.plantel_id IS NOT NULL AS mapped FROM base7_kaggle_clean b LEFT JOIN catalogo_planteles c ON b.plantel_estandarizado = c.plantel_canonico")
def mapped_values(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "catalogo_planteles").select(F.col("plantel_canonico").alias("plantel_estandarizado"), F.col("plantel_display").alias("shown"), "plantel_id")
    return base(spark, d).join(c, "plantel_estandarizado", "left").select("thesis_id", F.coalesce("shown", "plantel_estandarizado").alias("plantel"), F.col("plantel_id").isNotNull().alias("mapped"))


@entry("WITH v AS (SELECT DISTINCT trim(programa) AS value FROM base7_kaggle_clean WHERE trim(programa) <> ''), c AS (SELECT value, row_number() OVER (ORDER BY value) AS code FROM v) SELECT b.thesis_id, coalesce(c.code, 0) AS code FROM base7_kaggle_clean b LEFT JOIN c ON trim(b.programa) = c.value")
def category_codes(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).withColumn("value", F.trim("programa"))
    return b.join(R.dense_codes(b, "programa"), "value", "left").select("thesis_id", F.coalesce("code", F.lit(0)).alias("code"))


@entry('SELECT thesis_id, CASE WHEN "año" > 1800 THEN "año" // 10 * 10 END AS decada FROM base7_kaggle_clean')
def decade(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", F.when(F.col("año") > 1800, F.expr("`año` div 10 * 10")).alias("decada"))


@entry("SELECT thesis_id, CASE WHEN length(trim(biblionumber)) >= 9 THEN trim(biblionumber) ELSE lpad(trim(biblionumber), 9, '0') END AS biblionumber FROM base7_kaggle_clean WHERE biblionumber IS NOT NULL")
def padded_ids(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where("biblionumber IS NOT NULL").select("thesis_id", X.padded(F.col("biblionumber"), 9).alias("biblionumber"))


@entry(
    "WITH n AS (SELECT clusterid, min(label) AS label, min(macroid) AS macroid FROM cluster_nodes_final_50k WHERE clusterid IS NOT NULL GROUP BY 1) "
    "SELECT v.vec_id, v.cluster, n.label, n.macroid, b.programa, b.plantel_display FROM sample_50k_embeddings v LEFT JOIN n ON v.cluster = n.clusterid LEFT JOIN base7_kaggle_clean b USING (thesis_id)"
)
def join_chain(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "cluster_nodes_final_50k").where("clusterid IS NOT NULL").groupBy(F.col("clusterid").alias("cluster")).agg(F.min("label").alias("label"), F.min("macroid").alias("macroid"))
    v = table(spark, d, "sample_50k_embeddings").select("vec_id", "thesis_id", "cluster")
    return v.join(n, "cluster", "left").join(base(spark, d).select("thesis_id", "programa", "plantel_display"), "thesis_id", "left").select("vec_id", "cluster", "label", "macroid", "programa", "plantel_display")


@entry("SELECT plantel_id, plantel_display, coalesce(n, 0) AS n FROM catalogo_planteles LEFT JOIN (SELECT plantel_estandarizado, count(*) AS n FROM base7_kaggle_clean GROUP BY 1) ON plantel_canonico = plantel_estandarizado")
def join_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    counts = base(spark, d).groupBy(F.col("plantel_estandarizado").alias("plantel_canonico")).agg(F.count("*").alias("n"))
    return R.one_to_one(table(spark, d, "catalogo_planteles"), counts, "plantel_canonico").select("plantel_id", "plantel_display", F.coalesce("n", F.lit(0)).alias("n"))


@entry(
    "WITH a AS (SELECT \"año\" AS anio, count(*) AS base_n FROM base7_kaggle_clean WHERE source_record = 'base6' GROUP BY 1), m AS (SELECT \"año\" AS anio, count(*) AS marc_n FROM base7_kaggle_clean WHERE source_record <> 'base6' GROUP BY 1) "
    "SELECT coalesce(a.anio, m.anio) AS anio, coalesce(base_n, 0) AS base_n, coalesce(marc_n, 0) AS marc_n FROM a FULL JOIN m ON a.anio = m.anio"
)
def outer_years(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).select("source_record", F.col("año").alias("anio"))
    a = b.where("source_record = 'base6'").groupBy("anio").agg(F.count("*").alias("base_n"))
    m = b.where("source_record <> 'base6'").groupBy("anio").agg(F.count("*").alias("marc_n"))
    return a.join(m, "anio", "full_outer").na.fill(0, ["base_n", "marc_n"]).select("anio", "base_n", "marc_n")


@entry("SELECT m.biblionumber, m.target_year, b.thesis_id FROM (SELECT DISTINCT biblionumber, target_year FROM marc_year_manifest WHERE biblionumber <> '') m JOIN base7_kaggle_clean b ON b.biblionumber = m.biblionumber")
def inner_lookup(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "marc_year_manifest").where("biblionumber <> ''").select("biblionumber", "target_year").distinct()
    return m.join(base(spark, d).select("biblionumber", "thesis_id"), "biblionumber")


@entry("SELECT b.thesis_id, min(m.title_result) AS title_result FROM base7_kaggle_clean b JOIN marc_year_manifest m ON b.biblionumber = m.biblionumber AND b.\"año\" = m.target_year AND lower(trim(coalesce(b.titulo_limpio, ''))) = lower(trim(coalesce(m.title_result, ''))) GROUP BY 1")
def composite_lookup(spark: SparkSession, d: str) -> DataFrame:
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    b = base(spark, d).select("thesis_id", "biblionumber", F.col("año").alias("target_year"), norm(F.col("titulo_limpio")).alias("t"))
    m = table(spark, d, "marc_year_manifest").select("biblionumber", "target_year", norm(F.col("title_result")).alias("t"), "title_result")
    return b.join(m, ["biblionumber", "target_year", "t"]).groupBy("thesis_id").agg(F.min("title_result").alias("title_result"))


@entry("SELECT thesis_id FROM base7_kaggle_clean WHERE biblionumber IN (SELECT biblionumber FROM marc_status_log WHERE download_status = 'failed')")
def semi_failed(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "marc_status_log").where("download_status = 'failed'").select("biblionumber")
    return base(spark, d).select("thesis_id", "biblionumber").join(failed, "biblionumber", "left_semi").select("thesis_id")


@entry("SELECT DISTINCT biblionumber FROM marc_year_manifest m WHERE biblionumber <> '' AND NOT EXISTS (SELECT 1 FROM marc_status_log l WHERE l.biblionumber = m.biblionumber)")
def anti_done(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "marc_year_manifest").where("biblionumber <> ''").select("biblionumber").distinct()
    return m.join(table(spark, d, "marc_status_log").select("biblionumber"), "biblionumber", "left_anti")


@entry(
    "WITH r AS (SELECT * FROM base7_kaggle_clean WHERE source_record <> 'base6'), b AS (SELECT thesis_id, titulo_normalizado, autor_limpio_v2, \"año\" AS anio, texto_completo_url, system_number FROM base7_kaggle_clean WHERE source_record = 'base6') SELECT thesis_id, "
    "EXISTS (SELECT 1 FROM r WHERE trim(r.titulo_normalizado) <> '' AND trim(r.autor_limpio_v2) <> '' AND r.titulo_normalizado = b.titulo_normalizado AND r.autor_limpio_v2 = b.autor_limpio_v2 AND r.\"año\" = b.anio) AS by_title, "
    "EXISTS (SELECT 1 FROM r WHERE trim(r.texto_completo_url) <> '' AND r.texto_completo_url = b.texto_completo_url) AS by_url, EXISTS (SELECT 1 FROM r WHERE trim(r.system_number) <> '' AND r.system_number = b.system_number) AS by_number FROM b"
)
def overlap_flags(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).withColumn("anio", F.col("año"))
    left, right = b.where("source_record = 'base6'"), b.where("source_record <> 'base6'")
    keys = {"by_title": ["titulo_normalizado", "autor_limpio_v2", "anio"], "by_url": ["texto_completo_url"], "by_number": ["system_number"]}
    return R.overlap_flags(left.select("thesis_id", *sum(keys.values(), [])), right, keys).select("thesis_id", *keys)


@entry("WITH o AS (SELECT vec_id AS pos, thesis_id FROM sample_50k_embeddings) SELECT pos, coalesce(b.area, '') AS area, coalesce(b.\"año\", 0) AS anio FROM o LEFT JOIN base7_kaggle_clean b USING (thesis_id)")
def align_order(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "sample_50k_embeddings").select(F.col("vec_id").alias("pos"), "thesis_id")
    return o.join(base(spark, d).select("thesis_id", "area", F.col("año").alias("anio")), "thesis_id", "left").select("pos", F.coalesce("area", F.lit("")).alias("area"), F.coalesce("anio", F.lit(0)).alias("anio"))


_TITLE_SQL = "trim(regexp_replace(translate(lower(coalesce({c}, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g'))"


@entry(
    f"WITH q AS (SELECT doc_id, {_TITLE_SQL.format(c='string_split(text, chr(10))[1]')} AS k FROM documents), b AS (SELECT min(thesis_id) AS thesis_id, {_TITLE_SQL.format(c='titulo_limpio')} AS k FROM base7_kaggle_clean GROUP BY 2), "
    "j AS (SELECT doc_id, thesis_id, k, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS pos FROM q JOIN b USING (k) WHERE k <> '') SELECT doc_id, thesis_id, pos FROM j WHERE pos <= 5"
)
def title_match(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "documents").select("doc_id", X.key(F.substring_index("text", "\n", 1)).alias("k")).where("k <> ''")
    b = base(spark, d).groupBy(X.key(F.col("titulo_limpio")).alias("k")).agg(F.min("thesis_id").alias("thesis_id"))
    return R.top_per(q.join(b, "k"), ["k"], 5, F.col("doc_id"), rank="pos").select("doc_id", "thesis_id", F.col("pos").cast("long").alias("pos"))


@entry("SELECT l.log_seq, b.thesis_id FROM marc_status_log l JOIN base7_kaggle_clean b ON lpad(trim(l.biblionumber), 9, '0') = lpad(trim(b.biblionumber), 9, '0')")
def padded_join(spark: SparkSession, d: str) -> DataFrame:
    pad = lambda c: X.padded(F.col(c), 9)
    b = base(spark, d).where("biblionumber IS NOT NULL").select(pad("biblionumber").alias("k"), "thesis_id")
    return table(spark, d, "marc_status_log").select(pad("biblionumber").alias("k"), "log_seq").join(b, "k").select("log_seq", "thesis_id")


@entry(
    "WITH v AS (SELECT plantel_estandarizado AS v, count(*) AS n FROM base7_kaggle_clean WHERE plantel_estandarizado <> '' GROUP BY 1), b AS (SELECT v, n, string_split(v, ' ')[1] AS k FROM v) "
    "SELECT a.v AS a, b.v AS b, CAST(levenshtein(a.v, b.v) AS INTEGER) AS d FROM b a JOIN b b ON a.k = b.k AND a.v < b.v WHERE abs(length(a.v) - length(b.v)) <= 2 AND levenshtein(a.v, b.v) <= 2"
)
def blocked_edit_join(spark: SparkSession, d: str) -> DataFrame:
    v = base(spark, d).where("plantel_estandarizado <> ''").groupBy(F.col("plantel_estandarizado").alias("v")).agg(F.count("*").alias("n")).withColumn("k", F.substring_index("v", " ", 1))
    return near_texts(v, "k", "v")


@entry("WITH e AS (SELECT DISTINCT macroid, clusterid FROM cluster_nodes_final_50k WHERE clusterid IS NOT NULL AND macroid IS NOT NULL), p AS (SELECT clusterid AS source, lead(clusterid) OVER (PARTITION BY macroid ORDER BY clusterid) AS target FROM e), n AS (SELECT DISTINCT clusterid AS node FROM e) SELECT node, target AS other FROM n JOIN p ON p.source = n.node WHERE target IS NOT NULL UNION ALL SELECT node, source FROM n JOIN p ON p.target = n.node")
def edge_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The other ends of the edges that each node is the source or the target of; edges lead from a cluster to the next
    one of its macro group."""
    e = table(spark, d, "cluster_nodes_final_50k").where("clusterid IS NOT NULL AND macroid IS NOT NULL").select("macroid", "clusterid").distinct()
    p = e.select(F.col("clusterid").alias("source"), F.lead("clusterid").over(Window.partitionBy("macroid").orderBy("clusterid")).alias("target")).where("target IS NOT NULL")
    n = e.select(F.col("clusterid").alias("node")).distinct()
    return n.join(p, F.col("node") == F.col("source")).select("node", F.col("target").alias("other")).unionByName(n.join(p, F.col("node") == F.col("target")).select("node", F.col("source").alias("other")))


@entry("WITH g AS (SELECT id, clusterid, macroid, row_number() OVER (PARTITION BY macroid, clusterid ORDER BY id) AS r FROM cluster_nodes_final_50k WHERE macroid IS NOT NULL AND clusterid IS NOT NULL) SELECT macroid, count(*) AS pairs FROM g a JOIN g b USING (macroid) WHERE a.r = 1 AND b.r = 1 AND a.clusterid < b.clusterid GROUP BY macroid")
def group_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "cluster_nodes_final_50k").where("macroid IS NOT NULL AND clusterid IS NOT NULL").select("macroid", "clusterid").distinct()
    n = e.groupBy("macroid").agg(F.count("*").alias("n")).where("n > 1")
    return n.select("macroid", F.expr("n * (n - 1) div 2").alias("pairs"))  # counted, not emitted


@entry(
    "WITH a AS (SELECT thesis_id, programa, plantel_display, \"año\" AS anio FROM base7_kaggle_clean WHERE source_record = 'base6'), m AS (SELECT thesis_id, programa, plantel_display, \"año\" AS anio FROM base7_kaggle_clean WHERE source_record <> 'base6') "
    "SELECT * FROM a WHERE anio NOT IN (2001, 2002, 2003) UNION ALL SELECT * FROM m WHERE anio IN (2001, 2002, 2003)"
)
def merge_union(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).select("source_record", "thesis_id", "programa", "plantel_display", F.col("año").alias("anio"))
    return R.union_by_years(b.where("source_record = 'base6'"), b.where("source_record <> 'base6'"), "anio", [2001, 2002, 2003]).drop("source_record")


@entry(
    "WITH l AS (SELECT column_name AS c FROM (DESCRIBE SELECT * FROM marc_status_log)), m AS (SELECT column_name AS c FROM (DESCRIBE SELECT * FROM marc_year_manifest)) "
    "SELECT coalesce(l.c, m.c) AS name, CASE WHEN l.c IS NULL THEN 'add' WHEN m.c IS NULL THEN 'fill' ELSE 'keep' END AS action FROM l FULL JOIN m ON l.c = m.c"
)
def column_plan(spark: SparkSession, d: str) -> DataFrame:
    frame = lambda n, f: spark.createDataFrame([(c, True) for c in table(spark, d, n).columns], f"name string, {f} boolean")
    j = frame("marc_status_log", "l").join(frame("marc_year_manifest", "m"), "name", "full_outer")
    return j.select("name", F.when(F.col("l").isNull(), "add").when(F.col("m").isNull(), "fill").otherwise("keep").alias("action"))


@entry("SELECT thesis_id, list_has_any(list_distinct(list_filter(list_transform(string_split(coalesce(asesores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> '')), list_distinct(list_filter(list_transform(string_split(coalesce(autores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> ''))) AS shared FROM base7_kaggle_clean")
def arrays_meet(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", F.arrays_overlap(X.clean_list(F.col("asesores_display")), X.clean_list(F.col("autores_display"))).alias("shared"))


@entry("SELECT count(*) AS n FROM (SELECT DISTINCT biblionumber FROM marc_status_log WHERE biblionumber IS NOT NULL AND biblionumber IN (SELECT biblionumber FROM marc_year_manifest))")
def key_overlap(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "marc_status_log").select("biblionumber").distinct().join(table(spark, d, "marc_year_manifest"), "biblionumber", "left_semi").agg(F.count("*").alias("n"))


@entry('SELECT thesis_id, \'TH_\' || lpad(CAST(row_number() OVER (ORDER BY "año" DESC, thesis_id) AS VARCHAR), 7, \'0\') AS new_id FROM base7_kaggle_clean')
def dense_ids(spark: SparkSession, d: str) -> DataFrame:
    return R.ids_over(base(spark, d).select("thesis_id", F.col("año").alias("anio")), [F.desc("anio"), F.col("thesis_id")]).select("thesis_id", "new_id")


@entry("SELECT DISTINCT nivel_estandar, area FROM base7_kaggle_clean")
def distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("nivel_estandar", "area").distinct()


@entry("SELECT biblionumber, log_seq, download_status FROM (SELECT *, row_number() OVER (PARTITION BY biblionumber ORDER BY log_seq DESC) AS r FROM marc_status_log) WHERE r = 1 AND biblionumber IS NOT NULL")
def latest_status(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "marc_status_log").where("biblionumber IS NOT NULL")
    return log.groupBy("biblionumber").agg(F.max_by(F.struct("log_seq", "download_status"), "log_seq").alias("x")).select("biblionumber", "x.log_seq", "x.download_status")


@entry("SELECT biblionumber, log_seq, title_result FROM (SELECT *, row_number() OVER (PARTITION BY biblionumber ORDER BY downloaded_at, log_seq) AS r FROM marc_status_log) WHERE r = 1")
def first_seen(spark: SparkSession, d: str) -> DataFrame:
    return R.keep_first(table(spark, d, "marc_status_log"), ["biblionumber"], F.col("downloaded_at"), F.col("log_seq")).select("biblionumber", "log_seq", "title_result")


@entry('SELECT thesis_id, "año" AS anio, programa FROM base7_kaggle_clean ORDER BY anio DESC, programa NULLS FIRST, thesis_id LIMIT 200')
def top_rows(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", F.col("año").alias("anio"), "programa").orderBy(F.desc("anio"), F.asc_nulls_first("programa"), "thesis_id").limit(200)


@entry("SELECT thesis_id, area, r FROM (SELECT thesis_id, area, row_number() OVER (PARTITION BY area ORDER BY \"año\" DESC, thesis_id) AS r FROM base7_kaggle_clean) WHERE r <= 5")
def top_per_area(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).select("thesis_id", "area", F.col("año").alias("anio"))
    return R.top_per(b, ["area"], 5, F.desc("anio"), F.col("thesis_id"), rank="r").select("thesis_id", "area", F.col("r").cast("long").alias("r"))


@entry("SELECT min(log_seq) AS log_seq, arg_min(biblionumber, struct_pack(a := downloaded_at, b := log_seq)) AS biblionumber FROM marc_status_log WHERE download_status = 'failed'")
def oldest_failed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "marc_status_log").where("download_status = 'failed'").agg(F.min("log_seq").alias("log_seq"), F.min_by("biblionumber", F.struct("downloaded_at", "log_seq")).alias("biblionumber"))


@entry("SELECT macroid, clusterid, size FROM (SELECT macroid, clusterid, max(size) AS size, row_number() OVER (PARTITION BY macroid ORDER BY max(size) DESC, clusterid) AS r FROM cluster_nodes_final_50k WHERE size >= 5 AND clusterid IS NOT NULL GROUP BY 1, 2) WHERE r <= 30")
def visible_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "cluster_nodes_final_50k").where("size >= 5 AND clusterid IS NOT NULL").groupBy("macroid", "clusterid").agg(F.max("size").alias("size"))
    return R.top_per(n, ["macroid"], 30, F.desc("size"), F.col("clusterid")).select("macroid", "clusterid", "size")


@entry(
    "WITH t AS (SELECT vec_id, coalesce(cluster, -1) AS g, coalesce(titulo_normalizado, '') AS title FROM sample_50k_embeddings LEFT JOIN base7_kaggle_clean USING (thesis_id)), r AS (SELECT *, row_number() OVER (PARTITION BY g, title ORDER BY vec_id) AS pos, count(*) OVER (PARTITION BY g, title) AS n FROM t) "
    "SELECT vec_id, g, CASE WHEN trim(title) <> '' AND pos = 2 AND n > 2 THEN n - 2 ELSE 0 END AS overflow FROM r WHERE trim(title) = '' OR pos <= 2"
)
def cap_per_title(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "sample_50k_embeddings").select("vec_id", "thesis_id", F.coalesce("cluster", F.lit(-1)).alias("g"))
    t = v.join(base(spark, d).select("thesis_id", F.coalesce("titulo_normalizado", F.lit("")).alias("title")), "thesis_id", "left").na.fill("", ["title"])
    return R.cap_per_title(t, "g", "title", [F.col("vec_id")], 2).select("vec_id", "g", "overflow")


@entry("SELECT g, vec_id, slot FROM (SELECT g, vec_id, row_number() OVER (PARTITION BY g ORDER BY vec_id) AS slot FROM (SELECT vec_id, coalesce(cluster, -1) AS g, coalesce(titulo_normalizado, '') AS title, row_number() OVER (PARTITION BY coalesce(cluster, -1), coalesce(titulo_normalizado, '') ORDER BY vec_id) AS pos FROM sample_50k_embeddings LEFT JOIN base7_kaggle_clean USING (thesis_id)) WHERE trim(title) = '' OR pos <= 2) WHERE slot <= 25")
def capped_slots(spark: SparkSession, d: str) -> DataFrame:
    return R.top_per(cap_per_title(spark, d), ["g"], 25, F.col("vec_id"), rank="slot").select("g", "vec_id", F.col("slot").cast("long").alias("slot"))


@entry("SELECT thesis_id, CAST(substr(thesis_id, 4) AS BIGINT) AS num, (CAST(substr(thesis_id, 4) AS BIGINT) - 1) // 1000 AS shard FROM base7_kaggle_clean")
def range_shards(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.id_number(F.col("thesis_id")).alias("num")).withColumn("shard", F.expr("(num - 1) div 1000"))


@entry("SELECT thesis_id, row_number() OVER (ORDER BY trim(regexp_replace(translate(lower(coalesce(titulo_limpio, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g')), thesis_id) AS place FROM base7_kaggle_clean")
def accentless_order(spark: SparkSession, d: str) -> DataFrame:
    k = base(spark, d).select("thesis_id", X.key(F.col("titulo_limpio")).alias("k"))
    return R.ids_over(k, [F.col("k"), F.col("thesis_id")], "%d").select("thesis_id", F.col("new_id").cast("long").alias("place"))


@entry("SELECT doc_id, source, n_chars, n_chars < max(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS fell FROM documents WHERE n_chars IS NOT NULL")
def lag_compare(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("n_chars IS NOT NULL")
    return docs.select("doc_id", "source", "n_chars", (F.col("n_chars") < F.lag("n_chars").over(Window.partitionBy("source").orderBy("doc_id"))).alias("fell"))


@entry("WITH t AS (SELECT doc_id, source, CASE WHEN n_chars > 1000 THEN 3 WHEN n_chars > 300 THEN 2 WHEN n_chars > 0 THEN 1 END AS level FROM documents) SELECT doc_id, coalesce(level < last_value(level IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS regressed FROM t")
def level_regression(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "source", F.when(F.col("n_chars") > 1000, 3).when(F.col("n_chars") > 300, 2).when(F.col("n_chars") > 0, 1).alias("level"))
    return t.select("doc_id", R.ever_fell("level", "source", "doc_id").alias("regressed"))


QUERIES = queries_of(globals())
