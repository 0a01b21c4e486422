"""Texts within two edits of each other, in blocks of any size, without comparing all of a block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbrera.plans.lineage import cut, drop, spread

#: Texts up to SHORT characters meet by deletions, longer ones by thirds; a few lengths do both, so that two texts whose
#: lengths differ by two have one way in common.
SHORT, BOTH = 82, 79
_KEYS = T.StructType([T.StructField("own", T.ArrayType(T.LongType())), T.StructField("sought", T.ArrayType(T.LongType()))])


def _hashed(block: str, parts) -> np.ndarray:
    return pd.util.hash_array(np.array([f"{block}|{p}" for p in parts], dtype=object), categorize=False).view(np.int64)


def _left_over(word: str) -> set[str]:
    """A text, and what is left of it after one or two deletions."""
    out = front = {word}
    for _ in range(2):
        front = {t[:i] + t[i + 1 :] for t in front for i in range(len(t))}
        out = out | front
    return out


@F.pandas_udf(T.ArrayType(T.LongType()))
def deletion_keys(block: pd.Series, word: pd.Series) -> pd.Series:
    """Keys of a text, and of what is left of it after up to two deletions, inside a block: texts of one block within two
    edits have a key in common. Their number grows with the square of the length: for names and other short texts."""
    return pd.Series([_hashed(b, _left_over(w)) for b, w in zip(block, word, strict=True)], dtype=object)


def _thirds(n: int) -> list[tuple[int, int]]:
    """(start, end) of the three parts of a text of ``n`` characters."""
    at = [0, n // 3, 2 * n // 3, n]
    return list(zip(at, at[1:]))


@F.pandas_udf(_KEYS)
def _text_keys(block: pd.Series, word: pd.Series) -> pd.DataFrame:
    """Keys that a text has, and keys under which it seeks others (null where they are the same). Two edits leave a third
    of the one text whole, at most two places from where it stands in the other."""
    own, sought = [], []
    for b, w in zip(block, word, strict=True):
        mine: list[str] = []
        theirs: list[str] = []
        if len(w) <= SHORT:
            mine = theirs = [f"d{t}" for t in _left_over(w)]
        if len(w) >= BOTH:
            mine = mine + [f"{len(w)}/{i}/{w[s:e]}" for i, (s, e) in enumerate(_thirds(len(w)))]
            theirs = theirs + list({f"{n}/{i}/{w[s + k : e + k]}" for n in range(len(w) - 2, len(w) + 3) for i, (s, e) in enumerate(_thirds(n)) for k in range(-2, 3) if 0 <= s + k and e + k <= len(w)})
        own.append(_hashed(b, mine))
        sought.append(None if theirs is mine else _hashed(b, theirs))
    return pd.DataFrame({"own": pd.Series(own, dtype=object), "sought": pd.Series(sought, dtype=object)})


def _sought() -> Column:
    return F.explode(F.coalesce("keys.sought", "keys.own")).alias("key")


def meeting(texts: DataFrame, key: str, block: str, text: str, seeks: str = "true", owns: str = "true") -> DataFrame:
    """(a, b), cut: the keys of two rows whose texts may be within two edits in one block, once each; a is one of those
    that seek, b of those that own. Only keys and hashes are exchanged, by a merge join: what the rows of a small table
    become when their keys are spelled out (some hundred each) would be broadcast by the size that they had before."""
    few = spread(texts.where(f"({seeks}) OR ({owns})").select(F.col(key).alias("id"), F.expr(seeks).alias("seeks"), F.expr(owns).alias("owns"), F.col(block).alias("k"), F.col(text).alias("v")))
    keyed = cut(few.select("id", "seeks", "owns", _text_keys("k", "v").alias("keys")), "meeting-keys")
    own = keyed.where("owns").select(F.explode("keys.own").alias("key"), F.col("id").alias("b"))
    met = cut(keyed.where("seeks").select(_sought(), F.col("id").alias("a")).join(own.hint("merge"), "key").where("a <> b").select("a", "b").distinct(), "meeting")
    drop(keyed)
    return met


def near_texts(texts: DataFrame, block: str, text: str) -> DataFrame:
    """(a, b, d): pairs a < b of different texts of one block with a Levenshtein distance d of one or two. Null texts and
    blocks meet nothing; repeated rows count once."""
    t = texts.select(F.col(block).alias("k"), F.col(text).alias("v")).where("k IS NOT NULL AND v IS NOT NULL").distinct()
    keyed = cut(spread(t).withColumn("keys", _text_keys("k", "v")), "text-keys")
    own = keyed.select(F.explode("keys.own").alias("key"), F.col("k").alias("ka"), F.col("v").alias("a"))
    met = keyed.select(_sought(), "k", F.col("v").alias("b")).join(own, "key").where("a <> b AND k = ka")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.withColumn("d", F.levenshtein("a", "b", 2)).where("d > 0")
