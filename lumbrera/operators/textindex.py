"""Term statistics, inverted indexes and their codec."""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbrera.functions import text as X
from lumbrera.operators.relational import ids_over, top_per
from lumbrera.plans.lineage import cut

#: Words that say nothing about a topic.
STOPWORDS = (
    "al", "ante", "aqui", "asi", "by", "como", "con", "cual", "de", "del", "desde", "el", "en", "entre", "es", "esta", "este", "for", "from", "ha", "hay", "in", "is", "la", "las", "lo", "los", "mas", "no", "of", "on", "or", "para",
    "pero", "por", "que", "se", "sin", "sobre", "son", "su", "sus", "that", "the", "this", "to", "un", "una", "uno", "was", "were", "with", "ya", "em", "um", "uma", "da", "do", "dos", "as", "os", "ao", "and", "are",
)


def tokens(c: Column, least: int = 2) -> Column:
    """Plain lower-case words of at least ``least`` letters or digits, stop words left out, in order."""
    words = F.split(X.key(c), " ")
    return F.filter(words, lambda w: (F.length(w) >= least) & ~w.isin(*STOPWORDS))


def keyword_hits(df: DataFrame, text: Column, keywords: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, keyword, n): rows in which a keyword stands as a whole word."""
    plain = X.unaccent(F.lower(F.coalesce(text, F.lit(""))))
    import re

    sums = df.groupBy(*keys).agg(*[F.count_if(plain.rlike(rf"\b{re.escape(k)}\b")).alias(k) for k in keywords])
    return sums.unpivot(list(keys), list(keywords), "keyword", "n")


def term_counts(docs: DataFrame, group: str, key: str, text: Column, bigrams: bool = True) -> DataFrame:
    """(group, term, n): words, and pairs of neighbouring words, of each group's texts put together in key order.

    Words are numbered over the whole group, so pairs span texts. Each text contributes its inner pairs where it is
    read; only its last word and the next text's first one meet: texts are numbered over all groups in two steps, and
    each meets the one numbered before it, so a group of any size is no single task's."""
    # Written out once: left in the plan, the words of a text would be computed anew wherever they are mentioned.
    d = cut(docs.select(F.col(group).alias("g"), F.col(key).alias("k"), tokens(text).alias("ws")), "words").where(F.size("ws") > 0)
    ones = d.select("g", F.explode("ws").alias("term"))
    if not bigrams:
        return ones.groupBy("g", "term").agg(F.count("*").alias("n")).withColumnRenamed("g", group)
    inner = d.where(F.size("ws") > 1).select("g", F.explode(F.transform(F.sequence(F.lit(0), F.size("ws") - 2), lambda i: F.concat_ws(" ", F.get("ws", i), F.get("ws", i + 1)))).alias("term"))
    edge = ids_over(d.select("g", "k", F.get("ws", F.lit(0)).alias("first"), F.element_at("ws", -1).alias("last")), [F.col("g"), F.col("k")], "%d").withColumn("at", F.col("new_id").cast("long"))
    before = edge.select((F.col("at") + 1).alias("at"), F.col("g").alias("h"), F.col("last").alias("end"))
    across = edge.join(before, "at").where(F.col("g").eqNullSafe(F.col("h"))).select("g", F.concat_ws(" ", "end", "first").alias("term"))
    return ones.unionByName(inner).unionByName(across).groupBy("g", "term").agg(F.count("*").alias("n")).withColumnRenamed("g", group)


def class_tfidf(counts: DataFrame, group: str, top: int = 8, max_df: float = 0.5, least: int = 3) -> DataFrame:
    """(group, term, score, rank): class-based TF-IDF over (group, term, n).

    Terms in more than ``max_df`` of the groups leave first; a term's frequency is its share of its group's remaining
    terms; its rarity is ln(1 + A / f), f being its count over all groups and A the mean size of a group."""
    counts = cut(counts, "term-counts")  # read four times below
    groups = counts.select(group).distinct().agg(F.count("*").alias("groups"))
    spread_ = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("f"))
    kept = spread_.crossJoin(F.broadcast(groups)).where(F.col("df") <= F.col("groups") * max_df)  # groups: one row
    c = counts.join(kept.select("term", "f", "groups"), "term")
    size = c.groupBy(group).agg(F.sum("n").alias("words"))
    mean = c.agg((F.sum("n") / F.first("groups")).alias("a"))
    scored = c.join(size, group).crossJoin(F.broadcast(mean)).where(F.col("f") >= least)  # mean: one row
    s = scored.withColumn("score", F.round(F.col("n") / F.col("words") * F.log(1 + F.col("a") / F.col("f")), 6)).where("score > 0")
    return top_per(s, [group], top, F.desc("score"), F.col("term")).select(group, "term", "score", F.col("rank").cast("long").alias("rank"))


def labels(ranked: DataFrame, group: str) -> DataFrame:
    """(group, label): terms in rank order, joined by a middle dot."""
    return ranked.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), " · ").alias("label"))


def ngrams(words: Column, n: int) -> Column:
    """All runs of 1 to n neighbouring words of an array, joined by blanks."""

    def runs(k: int) -> Column:
        return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(words, *map(runs, range(2, n + 1))))


def tfidf_rows(docs: DataFrame, key: str, text: Column, n: int = 1) -> DataFrame:
    """(key, term, w): smoothed TF-IDF of runs of 1 to n words, rows scaled to length 1."""
    words = docs.select(F.col(key).alias("k"), tokens(text).alias("ws"))
    if n > 1:
        words = cut(words, "words")  # else the words of a text would be computed anew for every run
    t = words.select("k", F.explode(ngrams(F.col("ws"), n) if n > 1 else F.col("ws")).alias("term")).groupBy("k", "term").agg(F.count("*").alias("tf"))
    texts = docs.select(key).agg(F.count("*").alias("n"))
    df = t.groupBy("term").agg(F.count("*").alias("df"))
    w = t.join(df, "term").crossJoin(F.broadcast(texts)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))  # texts: one row
    length = w.groupBy("k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    return w.join(length, "k").select(F.col("k").alias(key), "term", (F.col("w") / F.col("len")).alias("w"))


def list_keywords(docs: DataFrame, key: str, text: Column, top: int = 18, least: int = 3, features: int = 400, n: int = 1) -> DataFrame:
    """(term, score): of the commonest terms (runs of 1 to n words) of a list of texts, those of greatest mean TF-IDF."""
    rows = tfidf_rows(docs, key, text, n)
    texts = docs.select(key).agg(F.count("*").alias("n"))
    total = rows.groupBy("term").agg(F.sum("w").alias("w"), F.count("*").alias("df"))
    common = total.orderBy(F.desc("df"), "term").limit(features)
    mean = common.crossJoin(F.broadcast(texts)).select("term", F.round(F.col("w") / F.col("n"), 6).alias("score"))  # texts: one row
    return mean.where(F.length("term") >= least).orderBy(F.desc("score"), "term").limit(top)


def sparse_products(rows: DataFrame, parent: str, key: str, least: float) -> DataFrame:
    """(source, target, weight): inner products of sparse rows (parent, key, term, w) that share a parent."""
    a = rows.select(parent, "term", F.col(key).alias("source"), F.col("w").alias("a"))
    b = rows.select(parent, "term", F.col(key).alias("target"), F.col("w").alias("b"))
    p = a.join(b, [parent, "term"]).where("source < target").groupBy("source", "target").agg(F.sum(F.col("a") * F.col("b")).alias("weight"))
    return p.where(F.col("weight") >= least)


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(term, ids): ascending ids of the texts that hold a term."""
    t = docs.select(F.col(key).alias("k"), F.explode(F.array_distinct(tokens(text))).alias("term"))
    return t.groupBy("term").agg(F.sort_array(F.collect_list("k")).alias("ids"))


def shard_of(index: DataFrame, limit: int = 200_000) -> DataFrame:
    """Adds ``shard``: two letters, or three where the two-letter shard is larger than ``limit`` (8 bytes an id)."""
    two = F.rpad(F.substring("term", 1, 2), 2, "_")
    sizes = index.groupBy(two.alias("two")).agg(F.sum(F.length("term") + 8 * F.size("ids")).alias("bytes"))
    three = F.concat(F.substring("term", 1, 3), F.when(F.length("term") < 3, F.lit("_")).otherwise(F.lit("")))
    return index.withColumn("two", two).join(sizes, "two").withColumn("shard", F.when(F.col("bytes") > limit, three).otherwise(F.col("two"))).drop("two", "bytes")


def search(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """(id): texts with all words, the last one matched as a beginning."""
    *whole, last = words
    out = index.where(F.col("term").startswith(last)).select(F.explode("ids").alias("id")).distinct()
    for w in whole:
        out = out.join(index.where(F.col("term") == w).select(F.explode("ids").alias("id")), "id", "left_semi")
    return out


_SEVENS = 7 * np.arange(1, 10)


def encode_ids(ids) -> str:
    """Ascending ids as base64 of variable-length differences: seven bits a byte, the low ones first, the top bit set
    on all bytes of a difference but its last. All differences of a list are laid out at once."""
    gaps = np.diff(np.asarray(list(ids), np.int64), prepend=0)
    if not len(gaps):
        return ""
    width = 1 + (gaps[:, None] >= (1 << _SEVENS)).sum(axis=1)
    ends = np.cumsum(width)
    which = np.repeat(np.arange(len(gaps)), width)
    place = np.arange(ends[-1]) - (ends - width)[which]
    low = (gaps[which] >> (7 * place)) & 0x7F
    return base64.b64encode((low + 0x80 * (place + 1 < width[which])).astype(np.uint8).tobytes()).decode()


def decode_ids(text: str) -> list[int]:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).astype(np.int64)
    if not len(raw):
        return []
    closing = np.nonzero(raw < 0x80)[0]
    begins = np.concatenate([[0], closing[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(begins, closing - begins + 1)
    return np.cumsum(np.add.reduceat((raw & 0x7F) << (7 * place), begins)).tolist()


@F.pandas_udf(T.StringType())
def encoded(ids: pd.Series) -> pd.Series:
    return ids.map(encode_ids)


@F.pandas_udf(T.ArrayType(T.LongType()))
def decoded(texts: pd.Series) -> pd.Series:
    return texts.map(decode_ids)


def word_forms(docs: DataFrame, text: Column) -> DataFrame:
    """(k, form, kind, n): how often each spelling of a word occurs, told as plain, accented, upper, title or lower."""
    w = docs.select(F.explode(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), 1)).alias("form"))
    c = w.groupBy("form").agg(F.count("*").alias("n"))
    return c.select(X.unaccent(F.lower("form")).alias("k"), "form", "n", (X.unaccent(F.lower("form")) != F.lower("form")).alias("accented"), ((F.col("form") == F.upper("form")) & (F.length("form") > 1)).alias("upper"), F.col("form").rlike(r"^\p{Lu}\p{Ll}").alias("title"))


def true_forms(forms: DataFrame, accent_share: float = 0.2, upper_share: float = 0.7, title_share: float = 0.965) -> DataFrame:
    """(k, n, form, kind): how a word should be written. The accented form wins from a fifth of the uses and two of
    them; a word is an acronym if it is mostly upper case, a proper noun if it nearly always begins with a capital."""
    total = F.sum("n")
    g = forms.groupBy("k").agg(
        total.alias("n"), F.sum(F.when(F.col("accented"), F.col("n")).otherwise(0)).alias("na"), F.sum(F.when(F.col("upper"), F.col("n")).otherwise(0)).alias("nu"), F.sum(F.when(F.col("title"), F.col("n")).otherwise(0)).alias("nt"),
        F.min_by(F.lower("form"), F.struct((~F.col("accented")).alias("x"), (-F.col("n")).alias("y"), F.lower("form").alias("z"))).alias("acc"),
    )
    written = F.when((F.col("na") >= accent_share * F.col("n")) & (F.col("na") >= 2), F.col("acc")).otherwise(F.col("k"))
    kind = F.when((F.col("nu") >= upper_share * F.col("n")) & (F.col("n") >= 3) & (F.length("k") <= 8), "sigla").when((F.col("nt") >= title_share * F.col("n")) & (F.col("n") >= 5), "propio").otherwise("comun")
    return g.select("k", "n", F.when(kind == "sigla", F.upper("k")).when(kind == "propio", F.initcap(written)).otherwise(written).alias("form"), kind.alias("kind"))
