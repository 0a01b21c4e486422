"""Queries over texts and the plane: term statistics, indexes, titles, objectives, tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.functions import text as X
from lumbrera.operators import lexicon as L
from lumbrera.operators import privacy as P
from lumbrera.operators import spatial as S
from lumbrera.operators import textindex as N
from lumbrera.operators.relational import top_per
from lumbrera.plans.lineage import cut
from lumbrera.queries import base, entry, queries_of, table

_STOP = "(" + ", ".join(f"'{w}'" for w in N.STOPWORDS) + ")"
_KEY = "trim(regexp_replace(translate(lower(coalesce({c}, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g'))"
_TOK = f"list_filter(string_split({_KEY}, ' '), lambda w: length(w) >= 2 AND w NOT IN {_STOP})"


@entry(f"SELECT thesis_id, {_KEY.format(c='titulo_limpio')} AS k FROM base7_kaggle_clean")
def normalize_key(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.key(F.col("titulo_limpio")).alias("k"))


@entry("SELECT thesis_id, trim(regexp_replace(coalesce(título, ''), '\\s+', ' ', 'g')) AS t FROM base7_kaggle_clean")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.clean(F.col("título")).alias("t"))


@entry("SELECT thesis_id, trim(regexp_replace(regexp_replace(upper(translate(coalesce(plantel_estandarizado, ''), 'áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ', 'aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC')), '\\bUAV\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS k FROM base7_kaggle_clean")
def upper_key(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.upper_key(F.col("plantel_estandarizado"), "UAV").alias("k"))


@entry("SELECT thesis_id, CASE WHEN contains(autor_limpio_v2, ',') THEN trim(trim(substr(autor_limpio_v2, strpos(autor_limpio_v2, ',') + 1)) || ' ' || trim(string_split(autor_limpio_v2, ',')[1])) ELSE trim(autor_limpio_v2) END AS nombre FROM base7_kaggle_clean WHERE autor_limpio_v2 IS NOT NULL")
def invert_name(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where("autor_limpio_v2 IS NOT NULL").select("thesis_id", X.invert_name(F.col("autor_limpio_v2")).alias("nombre"))


@entry("WITH s AS (SELECT thesis_id, list_filter(list_transform(string_split(coalesce(asesores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> '') AS a FROM base7_kaggle_clean), l AS (SELECT thesis_id, list_filter(a, lambda x, i: list_position(a, x) = i) AS a FROM s) SELECT thesis_id, len(a) AS n, a[1] AS first, array_to_string(a, ' | ') AS joined FROM l")
def list_clean(spark: SparkSession, d: str) -> DataFrame:
    a = base(spark, d).select("thesis_id", X.clean_list(F.col("asesores_display")).alias("a"))
    return a.select("thesis_id", F.size("a").cast("long").alias("n"), F.get("a", F.lit(0)).alias("first"), F.array_join("a", " | ").alias("joined"))


@entry("WITH l AS (SELECT thesis_id, list_filter(list_transform(string_split(coalesce(asesores_display, ''), '|'), lambda x: trim(x)), lambda x: x <> '') AS a FROM base7_kaggle_clean) SELECT thesis_id, CASE WHEN len(a) = 0 THEN 'sin asesor registrado' WHEN len(a) = 1 THEN a[1] ELSE a[1] || ' · +' || (len(a) - 1) || ' más' END AS label FROM l")
def ui_labels(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", X.ui_label(X.split_list(F.col("asesores_display")), "sin asesor registrado").alias("label"))


@entry("SELECT thesis_id, array_to_string(list_slice(string_split(asesor_limpio_v2, ','), 1, 2), ',') AS two FROM base7_kaggle_clean WHERE asesor_limpio_v2 IS NOT NULL")
def two_segments(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where("asesor_limpio_v2 IS NOT NULL").select("thesis_id", X.two_segments(F.col("asesor_limpio_v2")).alias("two"))


@entry("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(strftime(ts - INTERVAL 6 HOURS, '%Y-%m-%d') AS VARCHAR) AS day, strftime(ts - INTERVAL 6 HOURS, '%Y-%m') AS month FROM events")
def json_and_days(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.date_format(X.local_day(F.col("ts")), "yyyy-MM-dd").alias("day"), X.month_key(F.col("ts")).alias("month"))


@entry("SELECT event_id, strftime(CASE WHEN ts < date_trunc('day', ts) + INTERVAL 6 HOURS + INTERVAL 5 MINUTES THEN date_trunc('day', ts) + INTERVAL 6 HOURS + INTERVAL 5 MINUTES ELSE date_trunc('day', ts) + INTERVAL 30 HOURS + INTERVAL 5 MINUTES END, '%Y-%m-%d %H:%M') AS reset FROM events")
def next_reset(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.date_format(X.next_reset(F.col("ts")), "yyyy-MM-dd HH:mm").alias("reset"))


@entry("SELECT thesis_id, CASE WHEN contains(lower(coalesce(grado, '')), 'doctor') THEN 'doctorado' WHEN contains(lower(coalesce(grado, '')), 'maestr') THEN 'maestria' WHEN contains(lower(coalesce(grado, '')), 'especial') THEN 'especialidad' WHEN coalesce(trim(grado), '') = '' THEN '' ELSE 'licenciatura' END AS nivel, trim(regexp_replace(regexp_replace(lower(coalesce(grado, '')), '^(título|licenciatura|maestría|doctorado|especialidad) (de|en) ', ''), '^(la|el) ', '')) AS programa FROM base7_kaggle_clean")
def level_from_text(spark: SparkSession, d: str) -> DataFrame:
    g = F.lower(F.coalesce("grado", F.lit("")))
    nivel = F.when(g.contains("doctor"), "doctorado").when(g.contains("maestr"), "maestria").when(g.contains("especial"), "especialidad").when(F.trim(F.coalesce("grado", F.lit(""))) == "", "").otherwise("licenciatura")
    prog = F.trim(F.regexp_replace(F.regexp_replace(g, "^(título|licenciatura|maestría|doctorado|especialidad) (de|en) ", ""), "^(la|el) ", ""))
    return base(spark, d).select("thesis_id", nivel.alias("nivel"), prog.alias("programa"))


@entry("SELECT doc_id, len(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\n|;|\\.\\s+'), lambda x: trim(x, ' ')), lambda x: x <> '')) AS n FROM documents")
def split_objectives(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(X.objectives(F.col("text"))).cast("long").alias("n"))


_ORDERS = (
    "(?i)\\b(ignora|olvida|omite|descarta)\\w*\\s+(\\w+\\s+){0,3}(instrucci|indicaci|reglas|anterior)", "(?i)\\b(ignore|disregard|forget)\\s+(\\w+\\s+){0,3}(instructions|rules|previous|above)", "(?i)\\b(system|developer)\\s*(prompt|message|mensaje)", "(?i)\\bprompt\\s+(del\\s+)?sistema\\b",
    "(?im)^\\s*(system|assistant|user|sistema|asistente)\\s*:", "(?i)\\b(act[úuÚ]a|comp[óoÓ]rtate|responde)\\s+como\\b", "(?i)\\b(you are now|from now on|a partir de ahora eres)\\b", "(?i)‹/?\\s*(entrada_usuario|system|instructions?|instrucciones)",
)


@entry("SELECT doc_id, " + " + ".join(f"CAST(regexp_matches(coalesce(text, ''), '{p}') AS INTEGER)" for p in _ORDERS) + " AS hits FROM documents")
def injection_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.injection_count(F.coalesce("text", F.lit(""))).alias("hits"))


@entry()
def sanitised(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.sanitise(X.compose(F.col("text"))).alias("safe"))


@entry(
    f"WITH t AS (SELECT source, unnest({_TOK.format(c='text')}) AS term FROM documents), c AS (SELECT source, term, count(*) AS n FROM t GROUP BY 1, 2), dfs AS (SELECT term, count(*) AS df, sum(n) AS f FROM c GROUP BY 1), g AS (SELECT count(DISTINCT source) AS groups FROM c), k AS (SELECT c.*, f, groups FROM c JOIN dfs USING (term), g WHERE df <= groups * 0.5), "
    "w AS (SELECT source, sum(n) AS words FROM k GROUP BY 1), a AS (SELECT sum(n) / any_value(groups) AS a FROM k), s AS (SELECT source, term, round(n / words * ln(1 + a / f), 6) AS score FROM k JOIN w USING (source), a WHERE f >= 3), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS rank FROM s WHERE score > 0) SELECT source, term, score, rank FROM r WHERE rank <= 8"
)
def ctfidf_words(spark: SparkSession, d: str) -> DataFrame:
    return N.class_tfidf(N.term_counts(table(spark, d, "documents"), "source", "doc_id", F.col("text"), bigrams=False), "source")


@entry(
    f"WITH t AS (SELECT source, doc_id, {_TOK.format(c='text')} AS ws FROM documents), l AS (SELECT source, flatten(list(ws ORDER BY doc_id)) AS ws FROM t GROUP BY 1), u AS (SELECT source, unnest(ws) AS term FROM l UNION ALL SELECT source, ws[i] || ' ' || ws[i + 1] FROM (SELECT source, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM l)), "
    "c AS (SELECT source, term, count(*) AS n FROM u GROUP BY 1, 2), dfs AS (SELECT term, count(*) AS df, sum(n) AS f FROM c GROUP BY 1), g AS (SELECT count(DISTINCT source) AS groups FROM c), k AS (SELECT c.*, f, groups FROM c JOIN dfs USING (term), g WHERE df <= groups * 0.5), "
    "w AS (SELECT source, sum(n) AS words FROM k GROUP BY 1), a AS (SELECT sum(n) / any_value(groups) AS a FROM k), s AS (SELECT source, term, round(n / words * ln(1 + a / f), 6) AS score FROM k JOIN w USING (source), a WHERE f >= 3), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS rank FROM s WHERE score > 0) SELECT source, term, score, rank FROM r WHERE rank <= 8"
)
def ctfidf_top8(spark: SparkSession, d: str) -> DataFrame:
    return N.class_tfidf(N.term_counts(table(spark, d, "documents"), "source", "doc_id", F.col("text")), "source")


@entry()
def topic_labels(spark: SparkSession, d: str) -> DataFrame:
    return N.labels(ctfidf_top8(spark, d), "source")


@entry(
    f"WITH t AS (SELECT thesis_id, unnest({_TOK.format(c='titulo_limpio')}) AS term FROM base7_kaggle_clean), c AS (SELECT thesis_id, term, count(*) AS tf FROM t GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM base7_kaggle_clean), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1), w AS (SELECT thesis_id, term, df, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN f USING (term), n), l AS (SELECT thesis_id, sqrt(sum(w * w)) AS l FROM w GROUP BY 1), "
    "m AS (SELECT term, sum(w / l) AS s, count(*) AS df FROM w JOIN l USING (thesis_id) GROUP BY 1), k AS (SELECT * FROM m ORDER BY df DESC, term LIMIT 400) SELECT term, round(s / n, 6) AS score FROM k, n WHERE length(term) >= 3 ORDER BY score DESC, term LIMIT 18"
)
def list_keywords(spark: SparkSession, d: str) -> DataFrame:
    return N.list_keywords(base(spark, d), "thesis_id", F.col("titulo_limpio"))


@entry(
    f"WITH d AS (SELECT thesis_id, {_TOK.format(c='titulo_limpio')} AS ws FROM base7_kaggle_clean), t AS (SELECT thesis_id, unnest(ws) AS term FROM d UNION ALL SELECT thesis_id, ws[i] || ' ' || ws[i + 1] FROM (SELECT thesis_id, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM d) UNION ALL SELECT thesis_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM (SELECT thesis_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d)), "
    "c AS (SELECT thesis_id, term, count(*) AS tf FROM t GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM base7_kaggle_clean), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1), w AS (SELECT thesis_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN f USING (term), n), l AS (SELECT thesis_id, sqrt(sum(w * w)) AS l FROM w GROUP BY 1), "
    "m AS (SELECT term, sum(w / l) AS s, count(*) AS df FROM w JOIN l USING (thesis_id) GROUP BY 1), k AS (SELECT * FROM m ORDER BY df DESC, term LIMIT 400) SELECT term, round(s / n, 6) AS score FROM k, n WHERE length(term) >= 3 ORDER BY score DESC, term LIMIT 18"
)
def list_keyphrases(spark: SparkSession, d: str) -> DataFrame:
    return N.list_keywords(base(spark, d), "thesis_id", F.col("titulo_limpio"), n=3)


@entry(f"SELECT term, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS ids FROM (SELECT doc_id, unnest({_TOK.format(c='text')}) AS term FROM documents) GROUP BY term")
def inverted_postings(spark: SparkSession, d: str) -> DataFrame:
    return N.postings(table(spark, d, "documents"), "doc_id", F.col("text")).select("term", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@entry(
    f"WITH p AS (SELECT term, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, unnest({_TOK.format(c='text')}) AS term FROM documents) GROUP BY term), z AS (SELECT rpad(substr(term, 1, 2), 2, '_') AS two, sum(length(term) + 8 * n) AS bytes FROM p GROUP BY 1) "
    "SELECT term, CASE WHEN bytes > 2000 THEN substr(term, 1, 3) || CASE WHEN length(term) < 3 THEN '_' ELSE '' END ELSE two END AS shard FROM p JOIN z ON z.two = rpad(substr(p.term, 1, 2), 2, '_')"
)
def prefix_shards(spark: SparkSession, d: str) -> DataFrame:
    return N.shard_of(N.postings(table(spark, d, "documents"), "doc_id", F.col("text")), 2000).select("term", "shard")


@entry(f"WITH t AS (SELECT doc_id, {_TOK.format(c='text')} AS ws FROM documents) SELECT doc_id AS id FROM t WHERE list_contains(ws, 'agua') AND len(list_filter(ws, lambda w: starts_with(w, 'rec'))) > 0")
def index_search(spark: SparkSession, d: str) -> DataFrame:
    return N.search(cut(N.postings(table(spark, d, "documents"), "doc_id", F.col("text")), "index"), ["agua", "rec"])


@entry()
def postings_codec(spark: SparkSession, d: str) -> DataFrame:
    p = N.postings(table(spark, d, "documents"), "doc_id", F.col("text"))
    return p.select("term", N.encoded("ids").alias("packed"), (F.size(N.decoded(N.encoded("ids"))) == F.size("ids")).alias("whole"))


@entry(
    "WITH w AS (SELECT unnest(regexp_extract_all(text, '(\\p{L}+)', 1)) AS form FROM documents WHERE text IS NOT NULL), c AS (SELECT form, count(*) AS n FROM w GROUP BY 1) SELECT form, n, form = upper(form) AND length(form) > 1 AS upper FROM c"
)
def token_forms(spark: SparkSession, d: str) -> DataFrame:
    return N.word_forms(table(spark, d, "documents").where("text IS NOT NULL"), F.col("text")).select("form", "n", "upper")


@entry()
def true_forms(spark: SparkSession, d: str) -> DataFrame:
    return N.true_forms(N.word_forms(base(spark, d).where("`título` IS NOT NULL"), F.col("título")))


@entry(
    f"WITH c AS (SELECT id, min(clusterid) AS clusterid, min(macroid) AS macroid, min(label) AS label FROM cluster_nodes_final_50k WHERE macroid IS NOT NULL GROUP BY id), t AS (SELECT id, unnest({_TOK.format(c='label')}) AS term FROM c), n AS (SELECT count(*) AS n FROM c), tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY 1, 2), f AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), w AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN f USING (term), n), l AS (SELECT id, sqrt(sum(w * w)) AS l FROM w GROUP BY 1), u AS (SELECT id, macroid, term, w / l AS w FROM w JOIN l USING (id) JOIN c USING (id)) "
    "SELECT a.id AS source, b.id AS target, round(sum(a.w * b.w), 4) AS weight FROM u a JOIN u b ON a.macroid = b.macroid AND a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 0.02"
)
def label_edges(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "cluster_nodes_final_50k").where("macroid IS NOT NULL").groupBy("id").agg(F.min("macroid").alias("macroid"), F.min("label").alias("label"))
    r = cut(N.tfidf_rows(c, "id", F.col("label")).join(c.select("id", "macroid"), "id"), "label-rows")
    return N.sparse_products(r, "macroid", "id", 0.02).select("source", "target", F.round("weight", 4).alias("weight"))


@entry("SELECT thesis_id, CASE WHEN strpos(título, ' / ') > 0 THEN trim(substr(título, 1, strpos(título, ' / ') - 1)) ELSE trim(título) END AS t FROM base7_kaggle_clean WHERE título IS NOT NULL")
def simple_title_cut(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).where("`título` IS NOT NULL").select("thesis_id", P.simple_cut(F.col("título")).alias("t"))


@entry()
def title_cut(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", P.title_only("título").alias("t"), P.without_mentions("título").alias("u"))


@entry(f"SELECT thesis_id, CASE WHEN regexp_matches(título, '{P.LEAK}') THEN '{P.HIDDEN}' ELSE título END AS t FROM base7_kaggle_clean")
def leak_suppressed(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).select("thesis_id", P.suppressed(F.col("título")).alias("t"))


@entry("SELECT column_name AS path FROM (DESCRIBE SELECT * FROM base7_kaggle_clean) WHERE column_name IN ('autor_ui', 'autor_display')")
def forbidden_fields(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(p,) for p in P.forbidden_fields(base(spark, d), {"autor_ui", "autor_display"})], "path string")


@entry()
def objective_levels(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "documents").select("doc_id", F.posexplode(X.objectives(F.col("text"))).alias("pos", "objective"))
    return o.select("doc_id", "pos", L.level("objective").alias("r")).where("r.level IS NOT NULL").select("doc_id", "pos", "r.verb", "r.level", "r.upper", "r.ambiguous")


@entry()
def objective_flags(spark: SparkSession, d: str) -> DataFrame:
    return L.list_flags(objective_levels(spark, d), "doc_id", "pos")


_PLAIN = "translate(lower(coalesce(text, '')), 'áàâäãåéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc')"


@entry("SELECT doc_id, level, n FROM (" + " UNION ALL ".join(f"SELECT doc_id, {k} AS level, len(regexp_extract_all({_PLAIN}, '\\b((?:" + "|".join(v[:-2] for v in vs.split()) + ")(?:ar|er|ir))\\b', 1)) AS n FROM documents" for k, vs in L.LEVELS.items()) + ") WHERE n > 0")
def verb_prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.prefix_counts(table(spark, d, "documents"), "doc_id", F.col("text"))


def points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("embedding")[0].cast("double") * 40).alias("x"), (F.col("embedding")[1].cast("double") * 40).alias("y"), F.col("label").cast("long").alias("label"))


_P = "p AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) * 40 AS x, CAST(embedding[2] AS DOUBLE) * 40 AS y, CAST(label AS BIGINT) AS label FROM embeddings)"


@entry(f"WITH {_P}, e AS (SELECT min(x) AS x0, min(y) AS y0, greatest(max(x) - min(x), max(y) - min(y)) AS r FROM p) SELECT id, CAST(least(floor((x - x0) / (r / 64 * 1.0001)), 63) AS INTEGER) AS tx, CAST(least(floor((y - y0) / (r / 64 * 1.0001)), 63) AS INTEGER) AS ty FROM p, e")
def grid_tiles(spark: SparkSession, d: str) -> DataFrame:
    return S.tiles(points(spark, d)).select("id", "tx", "ty")


@entry(f"WITH {_P}, e AS (SELECT min(x) AS x0, min(y) AS y0, greatest(max(x) - min(x), max(y) - min(y)) AS r FROM p), t AS (SELECT id, least(floor((x - x0) / (r / 64 * 1.0001)), 63) AS tx, least(floor((y - y0) / (r / 64 * 1.0001)), 63) AS ty, least(floor((x - x0) / (r / 32 * 1.0001)), 31) * 2 AS nx, least(floor((y - y0) / (r / 32 * 1.0001)), 31) * 2 AS ny FROM p, e) SELECT id, CAST(tx AS INTEGER) AS tx, CAST(ty AS INTEGER) AS ty, CAST(nx AS INTEGER) AS new_tx, CAST(ny AS INTEGER) AS new_ty FROM t WHERE tx <> nx OR ty <> ny")
def moved_tiles(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    after = S.tiles(p, 32).withColumn("tx", F.col("tx") * 2).withColumn("ty", F.col("ty") * 2)
    return S.moved(S.tiles(p), after, "id")


@entry(f"WITH {_P}, k AS (SELECT CAST(floor(sqrt(x * x + y * y) / 0.2) AS BIGINT) AS ring FROM p) SELECT ring, count(*) AS n, round(count(*) / (pi() * 0.04 * ((ring + 1) * (ring + 1) - ring * ring)), 4) AS density FROM k WHERE ring < 60 GROUP BY 1")
def radial_density(spark: SparkSession, d: str) -> DataFrame:
    return S.rings(points(spark, d), F.lit(0.0), F.lit(0.0)).withColumn("density", F.round("density", 4))


@entry(f"WITH {_P}, k AS (SELECT CAST(floor(sqrt(x * x + y * y) / 0.2) AS BIGINT) AS ring FROM p), f AS (SELECT ring, count(*) / (pi() * 0.04 * ((ring + 1) * (ring + 1) - ring * ring)) AS density FROM k WHERE ring < 60 GROUP BY 1) SELECT CAST(round(min(ring) * 0.2, 4) AS DOUBLE) AS radius FROM f WHERE density >= (SELECT max(density) FROM f) * 0.3")
def core_radius(spark: SparkSession, d: str) -> DataFrame:
    return S.core_radius(S.rings(points(spark, d), F.lit(0.0), F.lit(0.0))).select(F.round("radius", 4).alias("radius"))


_NN = f"{_P}, d AS (SELECT a.id AS src, b.id AS dst, b.label, a.label AS own, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS dist FROM p a JOIN p b ON a.id <> b.id), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM d)"


@entry(f"WITH {_NN} SELECT src, dst, dist, rank FROM k WHERE rank <= 5")
def plane_neighbours(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    return S.k_nearest(p, p, 5, 1.0)


def _plane_vote(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    k = S.k_nearest(p, p, 15, 1.5).join(p.select(F.col("id").alias("dst"), "label"), "dst")
    v = k.groupBy("src", "label").agg(F.count("*").alias("c"))
    first = top_per(v, ["src"], 1, F.desc("c"), F.col("label")).select("src", F.col("label").alias("guess"))
    return first.join(p.select(F.col("id").alias("src"), F.col("label").alias("own")), "src")


@entry(f"WITH {_NN}, v AS (SELECT src, any_value(own) AS own, label, count(*) AS c FROM k WHERE rank <= 15 GROUP BY src, label), g AS (SELECT src, own, label, row_number() OVER (PARTITION BY src ORDER BY c DESC, label) AS r FROM v) SELECT src, label AS guess, own FROM g WHERE r = 1")
def knn2d_vote(spark: SparkSession, d: str) -> DataFrame:
    return _plane_vote(spark, d).select("src", "guess", "own")


@entry(f"WITH {_NN}, v AS (SELECT src, label, sum(1 / (dist + 0.01)) AS w FROM k WHERE rank <= 15 GROUP BY src, label), g AS (SELECT src, label, round(w / sum(w) OVER (PARTITION BY src), 4) AS confianza, row_number() OVER (PARTITION BY src ORDER BY round(w, 6) DESC, label) AS r FROM v) SELECT src, label AS guess, confianza FROM g WHERE r = 1")
def knn2d_weighted(spark: SparkSession, d: str) -> DataFrame:
    """The label of the 15 nearest in the plane, each counting by the inverse of its distance, with its share."""
    p = points(spark, d)
    k = S.k_nearest(p, p, 15, 1.5).join(p.select(F.col("id").alias("dst"), "label"), "dst")
    v = k.groupBy("src", "label").agg(F.sum(1 / (F.col("dist") + 0.01)).alias("w"))
    total = v.groupBy("src").agg(F.sum("w").alias("total"))
    first = top_per(v, ["src"], 1, F.desc(F.round("w", 6)), F.col("label")).join(total, "src")
    return first.select("src", F.col("label").alias("guess"), F.round(F.col("w") / F.col("total"), 4).alias("confianza"))


@entry(f"WITH {_NN}, v AS (SELECT src, any_value(own) AS own, label, count(*) AS c FROM k WHERE rank <= 15 GROUP BY src, label), g AS (SELECT src, own, label, row_number() OVER (PARTITION BY src ORDER BY c DESC, label) AS r FROM v), f AS (SELECT own, label AS guess FROM g WHERE r = 1) SELECT round((SELECT avg(CAST(own = guess AS INTEGER)) FROM f), 4) AS accuracy, round((SELECT max(c) FROM (SELECT count(*) AS c FROM f GROUP BY own)) / (SELECT count(*) FROM f), 4) AS baseline")
def vote_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return S.confusion(_plane_vote(spark, d), "own", "guess")


@entry()
def largest_hole(spark: SparkSession, d: str) -> DataFrame:
    cells = S.largest_hole(points(spark, d), bins=24, dilate=1)
    return spark.createDataFrame(cells, "tx int, ty int")


QUERIES = queries_of(globals())
