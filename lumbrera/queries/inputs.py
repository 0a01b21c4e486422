"""Queries that read, write and read again, and queries of scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.functions import parsing as J
from lumbrera.functions import text as X
from lumbrera.operators import vectors as V
from lumbrera.plans.lineage import scratch
from lumbrera.queries import base, entry, queries_of, table
from lumbrera.sources import readers as S
from lumbrera.sources import writers as K
from lumbrera.streaming import events as R

#: White space as Python's patterns know it, for SQL.
_WHITE = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _tidy(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_WHITE}', ' ', 'g'))"


@entry("SELECT * FROM nation")
def sql_scan(spark: SparkSession, d: str) -> DataFrame:
    return S.sql_table(spark, f"{d}/nation.parquet")


@entry("SELECT origen, count(*) AS n FROM base7_kaggle_clean GROUP BY 1")
def batch_scan(spark: SparkSession, d: str) -> DataFrame:
    """Counts of batches, added up."""
    counted = S.batches(S.columns(spark, f"{d}/base7_kaggle_clean.parquet", ["origen"]), lambda p: p.groupby("origen", dropna=False).size().reset_index(name="n"), "origen string, n long", 5000)
    return counted.groupBy("origen").agg(F.sum("n").alias("n"))


@entry("SELECT log_seq, biblionumber, download_status FROM marc_status_log")
def json_lines_trip(spark: SparkSession, d: str) -> DataFrame:
    """The log appended as JSON lines and read again without its heaviest field."""
    path = scratch(spark, "lines")
    K.append_lines(table(spark, d, "marc_status_log").select("log_seq", "biblionumber", "download_status", "error"), path)
    return S.json_lines(spark, path, "log_seq long, biblionumber string, download_status string, error string", without=["error"])


@entry("SELECT coalesce(biblionumber, '') AS biblionumber, coalesce(CAST(target_year AS VARCHAR), '') AS target_year, coalesce(detail_url, '') AS detail_url, coalesce(title_result, '') AS title_result, coalesce(manifest_status, '') AS manifest_status FROM marc_year_manifest")
def csv_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "report")
    K.report(table(spark, d, "marc_year_manifest").select("biblionumber", "target_year", "detail_url", "title_result", "manifest_status"), path)
    return S.csv_text(spark, path)


@entry("SELECT macroid, id FROM cluster_nodes_final_50k WHERE macroid IS NOT NULL")
def group_documents(spark: SparkSession, d: str) -> DataFrame:
    """The nodes of each macro group as one JSON document a file, read again."""
    nodes = table(spark, d, "cluster_nodes_final_50k").where("macroid IS NOT NULL").select("macroid", F.col("id").cast("string").alias("id"))
    docs = nodes.groupBy("macroid").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    path = scratch(spark, "documents")
    docs.select(F.to_json(F.struct("macroid", "ids")).alias("value"), F.col("macroid").alias("k")).repartition("k").write.partitionBy("k").text(path)
    kind = table(spark, d, "cluster_nodes_final_50k").schema["id"].dataType.simpleString()
    return S.json_documents(spark, path, "macroid int, ids array<string>").select("macroid", F.explode("ids").alias("id")).withColumn("id", F.col("id").cast(kind))


@entry("SELECT nullif(download_status, '') AS download_status, count(*) AS n, min(log_seq) AS first FROM marc_status_log GROUP BY 1")
def partitioned_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "partitioned")
    K.table(table(spark, d, "marc_status_log").select("log_seq", "download_status"), path, ["download_status"])
    return spark.read.parquet(path).groupBy("download_status").agg(F.count("*").alias("n"), F.min("log_seq").alias("first"))


@entry("SELECT coalesce(target_year, -1) AS shard, count(*) AS n FROM marc_status_log GROUP BY 1")
def resumed_shards(spark: SparkSession, d: str) -> DataFrame:
    """A job that stopped after half of its shards and is run again writes the rest, and nothing twice."""
    path = scratch(spark, "shards")
    rows = table(spark, d, "marc_status_log").select("log_seq", F.coalesce("target_year", F.lit(-1)).alias("shard"))
    K.append_shards(rows.where("pmod(shard, 2) = 0"), path, "shard")
    K.append_shards(rows, path, "shard")
    return spark.read.parquet(path).groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n"))


@entry("SELECT programa AS original, lower(trim(programa)) AS nuevo, count(*) AS filas, 'minusculas' AS regla FROM base7_kaggle_clean WHERE programa IS DISTINCT FROM lower(trim(programa)) GROUP BY 1, 2")
def versioned_audit(spark: SparkSession, d: str) -> DataFrame:
    old = base(spark, d).select("thesis_id", "programa")
    return K.versioned(old.withColumn("programa", F.lower(F.trim("programa"))), old, scratch(spark, "version"), "programa", "minusculas")


@entry("SELECT 'event: ' || event_type || chr(10) || 'data: {\"event_id\":' || event_id || ',\"user_id\":' || user_id || '}' || chr(10) || chr(10) AS frame FROM events")
def sse_frames(spark: SparkSession, d: str) -> DataFrame:
    return K.sse(table(spark, d, "events"), F.col("event_type"), F.struct("event_id", "user_id"))


@entry("SELECT 'documents' AS name, (SELECT count(*) FROM documents) AS rows, 7 AS columns, 'interno' AS policy UNION ALL SELECT 'catalogo_planteles', (SELECT count(*) FROM catalogo_planteles), 4, 'publico'")
def artefact_manifest(spark: SparkSession, d: str) -> DataFrame:
    tables = {n: table(spark, d, n) for n in ("documents", "catalogo_planteles")}
    return K.artefacts(tables["documents"], tables, {"catalogo_planteles": "publico"})


def _html(c: str) -> Column:
    """A text as a page shows it."""
    out = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


@entry("SELECT log_seq, nullif(" + _tidy("titulo_marc") + ", '') AS titulo, nullif(" + _tidy("system_number") + ", '') AS numero, 2 AS campos FROM marc_status_log")
def marc_pages(spark: SparkSession, d: str) -> DataFrame:
    """Record pages made from the log, parsed into their fields."""
    page = F.concat(F.lit("<table><tr><td>001 - Control</td><td>"), _html("system_number"), F.lit("</td></tr><tr><td>245 10 - T&iacute;tulo</td><td><b>"), _html("titulo_marc"), F.lit("</b></td></tr></table>"))
    log = table(spark, d, "marc_status_log").select("log_seq", S.marc_fields(page).alias("f"))
    of = lambda tag: F.get(F.get(F.filter("f", lambda x: x["tag"] == tag), F.lit(0))["subfields"], F.lit(0))
    return log.select("log_seq", of("245").alias("titulo"), of("001").alias("numero"), F.size("f").alias("campos"))


@entry("SELECT log_seq, biblionumber, " + _tidy("title_result") + " AS title, CASE WHEN target_year BETWEEN 1500 AND 2099 THEN CAST(target_year AS VARCHAR) ELSE '' END AS year FROM marc_status_log WHERE regexp_matches(biblionumber, '^[0-9]+$')")
def result_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of search results made from the log, parsed into entries. A page knows no number but digits."""
    log = table(spark, d, "marc_status_log").where(F.col("biblionumber").rlike("^[0-9]+$"))
    page = F.concat(F.lit('<ol><li><a href="/d?biblionumber='), F.col("biblionumber"), F.lit('">'), _html("title_result"), F.lit("</a> "), F.coalesce(F.col("target_year").cast("string"), F.lit("s/f")), F.lit(" </li></ol>"))
    return log.select("log_seq", F.explode(S.search_results(page)).alias("e")).select("log_seq", "e.biblionumber", "e.title", "e.year")


@entry("SELECT log_seq, nullif(regexp_extract(system_number, '^[0-9]+'), '') AS doc_number, CASE WHEN target_year BETWEEN 1500 AND 2099 THEN CAST(target_year AS VARCHAR) END AS year FROM marc_status_log")
def detail_pages(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "marc_status_log")
    page = F.concat(F.lit("<a href='/x?doc_number="), _html("system_number"), F.lit("'>ficha</a><table><tr><th>Año:</th><td>"), F.coalesce(F.col("target_year").cast("string"), F.lit("")), F.lit("</td></tr></table>"))
    return log.select("log_seq", S.details(page).alias("e")).select("log_seq", "e.doc_number", "e.year")


@entry(
    "SELECT thesis_id, CASE WHEN título IS NULL OR length(trim(título)) < 3 OR length(trim(título)) > 400 THEN 1 ELSE 0 END + CASE WHEN length(trim(programa)) > 160 THEN 1 ELSE 0 END + CASE WHEN length(trim(grado)) > 40 THEN 1 ELSE 0 END AS errors FROM base7_kaggle_clean"
)
def request_errors(spark: SparkSession, d: str) -> DataFrame:
    body = F.to_json(F.struct(F.col("título").alias("title"), F.col("programa").alias("program"), F.col("grado").alias("degree")))
    return S.requests(base(spark, d).select("thesis_id", body.alias("body")), "body").select("thesis_id", F.size("errors").alias("errors"))


@entry(
    "WITH s AS (SELECT vec_id, CAST(label % 2 AS INTEGER) AS m, list_transform(generate_series(1, 32), lambda i: (CAST(embedding[i] AS DOUBLE) + (label % 2) * CAST(embedding[i + 32] AS DOUBLE)) / (1 + label % 2)) AS v FROM embeddings) SELECT vec_id, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS first, round(v[32] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS last FROM s"
)
def masked_pooling(spark: SparkSession, d: str) -> DataFrame:
    """Each embedding's halves taken for the states of two tokens, the second one masked where the label is even."""
    e = table(spark, d, "embeddings")
    v = e.select("vec_id", V.masked_mean(F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)), F.array(F.lit(1), (F.col("label") % 2).cast("int"))).alias("v"))
    return v.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(31)), 6).alias("last"))


@entry("SELECT thesis_id, 'query: ' || concat_ws(' | ', titulo_limpio, programa, area) AS q FROM base7_kaggle_clean")
def query_texts(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", V.compose_query(F.col("titulo_limpio"), F.col("programa"), F.col("area")).alias("q"))


@entry("SELECT thesis_id, trim(regexp_replace(regexp_replace(translate(lower(coalesce(titulo_limpio, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^\\p{L}\\p{M}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS k FROM base7_kaggle_clean")
def word_keys(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.word_key(F.col("titulo_limpio")).alias("k"))


@entry("SELECT thesis_id, replace(replace(replace(replace(replace(replace(replace(autor_limpio_v2, 'Ã¡', 'á'), 'Ã©', 'é'), 'Ã' || chr(173), 'í'), 'Ã³', 'ó'), 'Ãº', 'ú'), 'Ã±', 'ñ'), 'Ã¼', 'ü') AS t FROM base7_kaggle_clean")
def repaired_letters(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.replace_all(F.col("autor_limpio_v2"), X.REPAIRS).alias("t"))


@entry(
    "WITH a AS (SELECT thesis_id, regexp_replace(trim(regexp_replace(coalesce(autor_limpio_v2, ''), '\\s+', ' ', 'g')), '\\$[a-z]', ' ', 'g') AS t FROM base7_kaggle_clean), b AS (SELECT thesis_id, regexp_replace(t, '(?i),?\\s*(asesora?|directora?|tutora?|autora?|sustentante)\\.?$', '') AS t FROM a), c AS (SELECT thesis_id, regexp_replace(t, ',?\\s*\\d{4}\\s*-?\\s*(\\d{4})?\\.?$', '') AS t FROM b) "
    "SELECT thesis_id, trim(regexp_replace(regexp_replace(t, '[\\s.,;:/]+$', ''), '\\s+', ' ', 'g')) AS nombre FROM c"
)
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.clean_name(F.col("autor_limpio_v2")).alias("nombre"))


@entry("SELECT log_seq, regexp_replace(trim(system_number), '\\.0$', '') AS n FROM marc_status_log")
def plain_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "marc_status_log").select("log_seq", X.without_point_zero(F.col("system_number")).alias("n"))


@entry("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '10.0.' || user_id % 256 || '.' || event_id % 256 ELSE '2001:db8:' || user_id % 256 || ':7::/64' END AS k FROM events")
def rate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Addresses as rate limits count them, made from the events' users: four parts, or the first half of eight."""
    user = (F.col("user_id") % 256).cast("string")
    four = F.concat(F.lit("10.0."), user, F.lit("."), (F.col("event_id") % 256).cast("string"))
    six = F.concat(F.lit("2001:db8:"), user, F.lit(":7:"), (F.col("event_id") % 999).cast("string"), F.lit("::1"))
    return table(spark, d, "events").select("event_id", X.rate_key(F.when(F.col("event_id") % 2 == 0, four).otherwise(six)).alias("k"))


@entry("SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 THEN '$.k: too large' ELSE '' END AS errors FROM events")
def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 50}}, "additionalProperties": False}
    return table(spark, d, "events").select("event_id", F.array_join(S.schema_checked(F.col("props"), schema), "; ").alias("errors"))


@entry("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS valor, 'ninguna' AS nota FROM events")
def normalised_props(spark: SparkSession, d: str) -> DataFrame:
    n = J.normalised(F.col("props"), {"valor": (("valor", "value", "k"), "bigint", "0"), "nota": (("nota", "note"), "string", "ninguna")})
    return table(spark, d, "events").select("event_id", n.alias("n")).select("event_id", "n.valor", "n.nota")


@entry("SELECT thesis_id, CASE WHEN contains(coalesce(universidad_nota, ''), 'UAV') THEN 'propia' WHEN coalesce(trim(universidad_nota), '') <> '' THEN 'externa/incorporada' ELSE '' END AS clase FROM base7_kaggle_clean")
def origins(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", J.origin(F.col("universidad_nota"), "UAV").alias("clase"))


def _single(sql: str) -> str:
    """Doubled letters made one, a letter at a time, since SQL's patterns know no reference back."""
    for c in "1abcdefgijklmnopqrstuxyz":
        sql = f"regexp_replace({sql}, '{c}+', '{c}', 'g')"
    return sql


_SOUND = "regexp_replace(translate(lower(autor_limpio_v2), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z]', '', 'g')"
for _a, _b in (("ch", "1"), ("ll", "y"), ("qu", "k"), ("ph", "f"), ("ce", "se"), ("ci", "si"), ("c", "k"), ("z", "s"), ("v", "b"), ("w", "u"), ("h", ""), ("y", "i")):
    _SOUND = f"replace({_SOUND}, '{_a}', '{_b}')"


@entry(f"SELECT thesis_id, {_single(_SOUND)} AS k FROM base7_kaggle_clean")
def sound_keys(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.phonetic(F.col("autor_limpio_v2")).alias("k"))


@entry(
    "WITH r AS (SELECT thesis_id, replace(replace(replace(replace(replace(replace(replace(coalesce(autor_limpio_v2, ''), 'Ã¡', 'á'), 'Ã©', 'é'), 'Ã' || chr(173), 'í'), 'Ã³', 'ó'), 'Ãº', 'ú'), 'Ã±', 'ñ'), 'Ã¼', 'ü') AS t FROM base7_kaggle_clean), "
    "k AS (SELECT thesis_id, regexp_replace(trim(regexp_replace(translate(lower(t), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g')), '\\b(m en [a-z]|dra?|mtr[oa]|lic|ing|profa?|arq|phd)\\b', ' ', 'g') AS k FROM r) SELECT thesis_id, array_to_string(list_filter(regexp_split_to_array(trim(k), '\\s+'), lambda w: w <> '' AND NOT regexp_matches(w, '^[0-9]{4}$')), ' ') AS words FROM k"
)
def name_words(spark: SparkSession, d: str) -> DataFrame:
    """A name's words as advisors are resolved by them: repaired, plain, without titles and years."""
    from lumbrera.operators.resolve import _words

    return base(spark, d).select("thesis_id", F.array_join(_words(F.coalesce("autor_limpio_v2", F.lit(""))), " ").alias("words"))


_CAMPUS = "trim(regexp_replace(translate(lower(coalesce({c}, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g'))"


@entry(
    "WITH b AS (SELECT thesis_id, plantel_estandarizado AS raw, " + _CAMPUS.format(c="plantel_estandarizado") + " AS k FROM base7_kaggle_clean) SELECT thesis_id, CASE WHEN k = '' THEN 'no especificado uav' WHEN c.plantel_id IS NOT NULL THEN c.plantel_canonico WHEN starts_with(k, 'programa de posgrado') THEN k || ' uav' WHEN starts_with(k, 'facultad') AND NOT contains(k, 'uav') THEN k || ' uav' ELSE k END AS estandar, "
    "CASE WHEN k = '' THEN 'No especificado' WHEN c.plantel_id IS NOT NULL THEN c.plantel_display ELSE trim(raw) END AS display FROM b LEFT JOIN catalogo_planteles c ON b.k = c.plantel_canonico OR (NOT contains(b.k, 'uav') AND b.k || ' uav' = c.plantel_canonico)"
)
def campus_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The standard and the shown name of a campus: those of the reference list, or by rules, or the text itself."""
    k = X.key(F.col("plantel_estandarizado"))
    own = F.when(F.col("k").contains("uav"), F.col("k")).otherwise(F.concat("k", F.lit(" uav")))
    b = base(spark, d).select("thesis_id", F.trim("plantel_estandarizado").alias("raw"), k.alias("k")).withColumn("own", own)
    c = table(spark, d, "catalogo_planteles").select(F.col("plantel_canonico").alias("own"), F.col("plantel_display").alias("shown"))
    j = b.join(c, "own", "left")  # one equality: a key without the home's name is looked up with it
    listed = F.col("shown").isNotNull()
    standard = F.when(F.col("k") == "", "no especificado uav").when(listed, F.col("own")).when(F.col("k").startswith("programa de posgrado"), F.concat("k", F.lit(" uav"))).when(F.col("k").startswith("facultad"), F.col("own")).otherwise(F.col("k"))
    return j.select("thesis_id", standard.alias("estandar"), F.when(F.col("k") == "", "No especificado").when(listed, F.col("shown")).otherwise(F.col("raw")).alias("display"))


@entry(
    "WITH p AS (SELECT event_id, event_type, epoch(ts) AS due, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS p FROM events) SELECT event_id, event_type, round(max(due - 45 * p) OVER (PARTITION BY event_type ORDER BY p) + 45 * p, 3) AS start FROM p"
)
def retry_lane(spark: SparkSession, d: str) -> DataFrame:
    """When a lane that begins one job each 45 seconds gets to each event, a lane a type."""
    e = table(spark, d, "events").select("event_id", "event_type", "ts", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("due"))
    return R.spaced(e, "event_type", "due", [F.col("ts"), F.col("event_id")], 45.0).select("event_id", "event_type", F.round("start", 3).alias("start"))


QUERIES = queries_of(globals())
