"""Rules over verbs: the level of a learning objective, and what is odd about a list of objectives."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lumbrera.functions.text import unaccent
from lumbrera.operators.relational import ever_fell

#: Verbs of each level of the taxonomy, in the infinitive, without accents.
LEVELS = {
    1: "conocer definir enumerar enunciar identificar listar mencionar nombrar recordar reconocer registrar repetir senalar",
    2: "caracterizar comprender describir discutir ejemplificar explicar exponer expresar interpretar ilustrar resumir ubicar traducir",
    3: "aplicar calcular demostrar ejecutar emplear implementar medir operar practicar resolver usar utilizar validar",
    4: "analizar categorizar clasificar comparar contrastar cuantificar determinar diagnosticar diferenciar distinguir examinar explorar investigar relacionar",
    5: "argumentar concluir criticar decidir estimar evaluar juzgar justificar ponderar recomendar seleccionar valorar verificar",
    6: "construir componer crear desarrollar disenar elaborar establecer formular generar idear inventar plantear producir proponer",
}
VERBS = {v: k for k, vs in LEVELS.items() for v in vs.split()}
NAMES = {1: "recordar", 2: "comprender", 3: "aplicar", 4: "analizar", 5: "evaluar", 6: "crear"}
#: Verbs that stand at one of two levels, and nouns that stand for a verb.
RANGES = {"determinar": (4, 5), "establecer": (3, 6), "estimar": (3, 5), "demostrar": (3, 5), "desarrollar": (3, 6), "explorar": (2, 4), "medir": (3, 5)}
NOUNS = {"analisis": "analizar", "evaluacion": "evaluar", "diseno": "disenar", "propuesta": "proponer", "comparacion": "comparar", "descripcion": "describir", "identificacion": "identificar", "estudio": "investigar", "desarrollo": "desarrollar", "aplicacion": "aplicar", "elaboracion": "elaborar", "caracterizacion": "caracterizar"}
_CLITIC = re.compile(r"(?:nos|les|los|las|le|lo|la|me|te|se|os){1,2}$")
RESULT = T.StructType([T.StructField(n, t) for n, t in (("verb", T.StringType()), ("level", T.IntegerType()), ("upper", T.IntegerType()), ("nominal", T.BooleanType()), ("ambiguous", T.BooleanType()))])


def lemma(word: str) -> str | None:
    """The infinitive that a form of a listed verb belongs to."""
    w = word
    if w in VERBS:
        return w
    bare = _CLITIC.sub("", w)
    if bare in VERBS:
        return bare
    for ends, to in ((("ando",), ("ar",)), (("iendo", "yendo"), ("er", "ir")), (("ado", "ada"), ("ar",)), (("ido", "ida"), ("er", "ir")), (("are", "aras", "ara", "aremos", "aran"), ("ar",)), (("ere", "era", "eremos", "eran"), ("er",)), (("ire", "ira", "iremos", "iran"), ("ir",)), (("amos", "an", "o", "a", "e", "en"), ("ar", "er", "ir")), (("imos", "emos"), ("er", "ir"))):
        for e in sorted(ends, key=len, reverse=True):
            if w.endswith(e):
                stem = w[: -len(e)]
                for t in to:
                    if stem + t in VERBS:
                        return stem + t
    return None


def classify(text: str | None) -> tuple[str | None, int | None, int | None, bool, bool]:
    """(verb, level, upper level, told by a noun, ambiguous) of an objective: its first listed verb rules."""
    if not text:
        return None, None, None, False, False
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    words = re.findall(r"[a-z]+", plain)
    if words and words[0] in NOUNS:
        v = NOUNS[words[0]]
        lo, hi = RANGES.get(v, (VERBS[v], VERBS[v]))
        return v, lo, hi, True, lo != hi
    for w in words:
        v = lemma(w)
        if v:
            lo, hi = RANGES.get(v, (VERBS[v], VERBS[v]))
            return v, lo, hi, False, lo != hi
    return None, None, None, False, False


@F.pandas_udf(RESULT)
def level(texts: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([classify(t) for t in texts], columns=["verb", "level", "upper", "nominal", "ambiguous"])
    return out.astype({"level": "Int32", "upper": "Int32"})


def prefix_counts(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, level, n): how many words of a text begin as a verb of each level does; the simpler, older rule, which
    runs in the JVM."""
    plain = unaccent(F.lower(F.coalesce(text, F.lit(""))))
    cols = [F.size(F.regexp_extract_all(plain, F.lit(r"\b((?:" + "|".join(v[:-2] for v in vs.split()) + r")(?:ar|er|ir))\b"), 1)).alias(str(k)) for k, vs in LEVELS.items()]
    wide = df.select(F.col(key), *cols)
    return wide.unpivot([key], [str(k) for k in LEVELS], "level", "n").where("n > 0").select(key, F.col("level").cast("int").alias("level"), F.col("n").cast("long").alias("n"))


def list_flags(levels: DataFrame, group: str, order: str, expected: DataFrame | None = None) -> DataFrame:
    """(group, n, one, many, same_level, regression, missing, gap, creates_unevaluated, maximum, below): what is odd about
    a list of objectives with a level each. ``missing`` are the levels between the least and the greatest that nothing
    has; ``below`` says whether the greatest is less than what ``expected`` (group, level) asks of the list."""
    fell = levels.withColumn("fell", ever_fell("level", group, order))
    out = fell.groupBy(group).agg(F.count("*").alias("n"), F.coalesce(F.bool_or("fell"), F.lit(False)).alias("regression"), F.count("level").alias("known"), F.array_sort(F.collect_set("level")).alias("u"), F.max("level").alias("maximum"))
    between = F.when(F.size("u") > 1, F.array_except(F.expr("sequence(u[0], element_at(u, -1))"), "u")).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("missing", between)
    least = expected.select(group, F.col("level").alias("least")) if expected is not None else None
    out = out.join(least, group, "left") if least is not None else out.withColumn("least", F.lit(None).cast("int"))
    return out.select(
        group, "n", (F.col("n") == 1).alias("one"), (F.col("n") > 6).alias("many"), ((F.size("u") == 1) & (F.col("known") > 1)).alias("same_level"), "regression", "missing", (F.size("missing") > 0).alias("gap"),
        ((F.col("known") > 1) & F.array_contains("u", 6) & ~F.array_contains("u", 5)).alias("creates_unevaluated"), "maximum", F.coalesce(F.col("maximum") < F.col("least"), F.lit(False)).alias("below"),
    )
