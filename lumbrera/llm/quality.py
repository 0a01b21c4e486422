"""Text quality statistics of documents, and what they tell: prose, list, table or junk.

A document is divided into blocks of consecutive lines of one build, so that a table inside prose is judged by itself.
Each block gets statistics (words, lines, symbols, repetition, ...). A Gaussian mixture with diagonal covariances is
fitted to the standardised statistics of all blocks, weighted by their characters, by expectation-maximization: each
round is one pass in which tasks add up sufficient statistics, a table of fixed size. Components take the class of the
inspected examples that they explain. A document has the class that most of its characters have.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.quality_examples import EXAMPLES
from lumbrera.plans.lineage import cut, spread

#: The commonest function words of Spanish, Portuguese and English.
COMMON = frozenset(
    "a al como con cuando de del desde donde e el ella en entre era es esta este esto fue ha hay la las le lo los más me mi muy ni no nos o para pero por que qué se ser si sin sobre son su sus también tiene todo un una unos y ya "
    "à ao aos as com da das do dos em foi foram mas na nas não no nos os ou pela pelo são sua tem uma "
    "an and are at be been by but can did do does for from had has have how i in into is it its may not of on only or our than that the their there these they this those to was we were what when where which who will with would".split()
)
STATS = ("palabras_comunes", "letras", "cifras", "simbolos", "largo_palabra", "fin_puntuado", "palabras_linea", "separadores", "compresion", "distintas", "marcas", "campos", "rotas", "lineas_cortas", "repetidas", "citas")
CLASSES = ("prosa", "lista", "tabla", "basura")
#: Least gain of log-likelihood a character for another round, least variance of a standardised statistic, characters
#: that a caption may have, and weight of the pseudo-example that holds a component at its start, in shares of all characters.
GAIN, FLOOR, CAPTION, PULL = 5e-3, 0.05, 160, 2e-4
#: Characters of a block from which its compression tells more than its share of different words; both count at any length.
COMPRESSED = 120
_MARK = re.compile(r"^(?:[-*•·–—+>▪◦]|\(?\d{1,3}[.)]|\d{1,2}(?:\.\d{1,2})+\.?|[a-zA-Z]\))\s+\S")
_LEADER = re.compile(r"\.{4,}\s*\d+\s*$")
_FIELD = re.compile(r"\t|\|| {3,}|;|=[^=]")
_WORD = re.compile(r"[^\W\d_]+")
_CITE = re.compile(r"(?<=\s)[^\W\d_]\.(?=\s)|\((?:1[5-9]|20)\d\d\)\.?")
_INVISIBLE = dict.fromkeys(map(ord, "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"))
_BROKEN = re.compile(r"[^\W\d_][^\w\s'’.,;:()\-–—/&ªº%]+[^\W\d_]|[bcdfghjklmnñpqrstvwxzBCDFGHJKLMNÑPQRSTVWXZ]{5,}|\w{23,}")


_SIGNS = re.compile(r"[.,;:()?!'\"¿¡\-–—«»“”’/]+")
_DIGITS = re.compile(r"[\d²³¹⁰⁴-⁹₀-₉]+")


@lru_cache(maxsize=1 << 16)
def _broken(token: str) -> bool:
    return _BROKEN.search(token) is not None


def _kind(line: str) -> str:
    if _LEADER.search(line):
        return "mark"
    if line[0] in "|+" or len(_FIELD.findall(line)) >= 2 and len(line) / (1 + len(_FIELD.findall(line))) < 28:
        return "fields"
    if _MARK.match(line):
        return "mark"
    return "short" if len(line.split()) <= 3 else "long"


def blocks(text: str) -> list[list[str]]:
    """Runs of non-blank lines of one build; a single line between two runs of another build stays by itself."""
    out: list[list[str]] = []
    last = None
    for line in re.split(r"[\n\r\v\f\x85  ]+", text):
        line = line.strip(" \xa0﻿​").rstrip("\t")
        if not line or line.isspace():
            continue
        kind = _kind(line)
        if kind != last:
            out.append([])
            last = kind
        out[-1].append(line)
    return out


def statistics(lines: list[str]) -> list[float]:
    """The numbers of STATS for the lines of a block."""
    return measures(lines)[0]


def measures(lines: list[str]) -> tuple[list[float], int, int, int]:
    """(the numbers of STATS for the lines of a block, its words, their letters, common words)."""
    text = "\n".join(lines)
    solid = "".join(text.split())
    n = max(1, len(solid))
    tokens = text.split()
    words = _WORD.findall(text.lower())
    letters = sum(map(len, words))
    digits = sum(map(len, _DIGITS.findall(solid)))
    marks = sum(map(len, _SIGNS.findall(solid)))
    common = sum(w in COMMON for w in words)
    m, k = max(1, len(tokens)), len(lines)
    kinds = len(set(tokens))
    raw = text.encode("utf-8", "replace")
    weight = len(raw) / (len(raw) + COMPRESSED)
    packed = weight * min(1.1, len(zlib.compress(raw, 1)) / max(len(raw), 24)) + (1 - weight) * 0.8 * min(1.0, 0.3 + kinds / m)
    fields = [len(_FIELD.findall(x)) for x in lines]
    same = sum(a >= 2 and (i == 0 or fields[i - 1] == a or i + 1 < k and fields[i + 1] == a) for i, a in enumerate(fields)) / k
    letters_used = set(solid)
    stars = max(map(solid.count, letters_used)) if 0 < len(letters_used) < 12 else 0
    values = [
        common / m,
        letters / n,
        digits / n,
        min(1.0, max(0, len(solid) - letters - digits - marks) / n * 2),
        min(12.0, letters / max(1, len(words))) / 4,
        sum(x[-1] in ".!?…:»”\"" for x in lines) / k,
        np.log1p(m / k),
        min(2.0, (sum(text.count(c) for c in ";,/|·=\t") + text.count("   ")) / m),
        packed,
        kinds / m,
        sum(bool(_MARK.match(x) or _LEADER.search(x)) for x in lines) / k,
        same,
        min(1.0, sum(map(_broken, tokens)) / m),
        sum(len(x.split()) <= 3 for x in lines) / k,
        1.0 if stars > n * 0.4 or m >= 8 and kinds <= m / 8 and m / k > 4 else 0.0,
        min(2.0, len(_CITE.findall(text)) / k),
    ]
    return values, len(words), letters, common


def document_statistics(text: str | None) -> tuple:
    """(words, mean word length, symbol ratio, share of lines ending in punctuation, share of common words) of a whole
    document; zeros for null and blank texts."""
    return _whole(text, [measures(b) for b in blocks(text)] if text else [])


def _whole(text: str | None, parts: list[tuple]) -> tuple:
    """document_statistics() from the measures of the blocks."""
    lines = [x.strip() for x in re.split(r"[\n\r]+", text or "") if x.strip()]
    words, letters, common = (sum(p[i] for p in parts) for i in (1, 2, 3))
    solid = "".join((text or "").split())
    plain = sum(map(str.isalnum, solid))
    return (
        words,
        round(letters / max(1, words), 4),
        round((len(solid) - plain) / max(1, len(solid)), 4),
        round(sum(x[-1] in ".!?…:»”\"" for x in lines) / max(1, len(lines)), 4),
        round(common / max(1, words), 4),
    )


def _density(z: np.ndarray, model: dict) -> np.ndarray:
    """Log of weight x density of each component (columns) for standardised rows."""
    out = np.empty((len(z), len(model["w"])))
    for j in range(out.shape[1]):
        d = z - model["mu"][j]
        out[:, j] = model["logw"][j] - 0.5 * ((d * d / model["var"][j]).sum(axis=1) + np.log(model["var"][j]).sum())
    return out


def _shares(z: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(share of each component, log-likelihood up to a constant) of each row."""
    d = _density(z, model)
    top = d.max(axis=1, keepdims=True)
    p = np.exp(d - top)
    total = p.sum(axis=1, keepdims=True)
    return p / total, (top + np.log(total))[:, 0]


def start(mean: np.ndarray, sd: np.ndarray) -> tuple[dict, np.ndarray, list[str]]:
    """A component for each kind of example, the standardised examples, and the class of each."""
    rows, classes, kinds = [], [], []
    for kind, cls, texts in EXAMPLES:
        for t in texts:
            for b in blocks(t):
                rows.append(statistics(b))
                classes.append(cls)
                kinds.append(kind)
    z = (np.array(rows) - mean) / sd
    names = list(dict.fromkeys(kinds))
    mu = np.array([z[[k == n for k in kinds]].mean(axis=0) for n in names])
    w = np.full(len(names), 1 / len(names))
    return {"w": w, "logw": np.log(w), "mu": mu, "var": np.full(mu.shape, 0.5)}, z, classes


def label_components(model: dict, z: np.ndarray, classes: list[str]) -> list[str]:
    """For each component the class whose examples it explains best, each class's examples counting alike."""
    p = _shares(z, model)[0]
    weight = np.array([1 / classes.count(c) for c in classes])
    score = np.array([[(p[:, j] * weight)[[x == c for x in classes]].sum() for c in CLASSES] for j in range(p.shape[1])])
    out = []
    for j in range(p.shape[1]):
        if score[j].max() > 1e-3:
            out.append(CLASSES[int(score[j].argmax())])
        else:  # it explains no example: the nearest one speaks for it
            d = ((z - model["mu"][j]) ** 2 / (model["var"][j] + 0.3)).sum(axis=1)
            out.append(classes[int(d.argmin())])
    return out


def fit(features: DataFrame, rounds: int | None = None, pull: float = PULL) -> tuple[dict, np.ndarray, np.ndarray, list[str]]:
    """(model, mean, sd, class of each component) over a table (n long, x array<double>) of blocks. Rounds go on until
    the log-likelihood a character gains less than GAIN, or for ``rounds``."""
    dim = len(STATS)
    spark = features.sparkSession

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros(1 + 2 * dim)
        for pdf in batches:
            if len(pdf):
                x, n = np.stack(pdf["x"].to_list()), pdf["n"].to_numpy(float)[:, None]
                acc += np.concatenate([[n.sum()], (n * x).sum(axis=0), (n * x * x).sum(axis=0)])
        yield pd.DataFrame({"i": np.arange(len(acc)), "s": acc})

    def summed(f) -> np.ndarray:
        got = features.mapInPandas(f, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").toPandas()
        return got["s"].to_numpy()

    t = summed(totals)
    if not len(t) or t[0] <= 0:
        return {}, np.zeros(dim), np.ones(dim), []
    mean = t[1 : 1 + dim] / t[0]
    sd = np.sqrt(np.maximum(t[1 + dim :] / t[0] - mean**2, 1e-4))
    model, z, classes = start(mean, sd)
    k = len(model["w"])
    origin, held = model["mu"], t[0] * pull
    before, done = -np.inf, 0
    while rounds is None or done < rounds:
        shared = spark.sparkContext.broadcast((model, mean, sd))

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m, mu, s = shared.value
            acc, likely = np.zeros((k, 1 + 2 * dim)), 0.0
            for pdf in batches:
                if len(pdf):
                    x, n = (np.stack(pdf["x"].to_list()) - mu) / s, pdf["n"].to_numpy(float)[:, None]
                    p, lik = _shares(x, m)
                    p, likely = p * n, likely + float((lik * n[:, 0]).sum())
                    acc += np.concatenate([p.sum(axis=0)[:, None], p.T @ x, p.T @ (x * x)], axis=1)
            yield pd.DataFrame({"i": np.arange(acc.size + 1), "s": np.append(acc.ravel(), likely)})

        got = summed(expect)
        a, likely = got[:-1].reshape(k, 1 + 2 * dim), got[-1] / t[0]
        # Each component is also held by one pseudo-example at its start, worth a small share of all characters.
        w = a[:, 0] + held
        mu = (a[:, 1 : 1 + dim] + held * origin) / np.maximum(w, 1e-9)[:, None]
        var = np.maximum((a[:, 1 + dim :] + held * (origin**2 + 0.5)) / np.maximum(w, 1e-9)[:, None] - mu**2, FLOOR)
        w = np.maximum(w / w.sum(), 1e-12)
        model = {"w": w, "logw": np.log(w), "mu": mu, "var": var}
        shared.unpersist()
        done += 1
        if likely - before < GAIN:
            break
        before = likely
    return model, mean, sd, label_components(model, z, classes)


def classify(docs: DataFrame, key: str = "doc_id", column: str = "text", rounds: int | None = None, pull: float = PULL) -> DataFrame:
    """(key, palabras, largo_medio, simbolos, fin_puntuado, comunes, clase, parte): statistics and class of every row.

    Null and blank texts have zeros and null class. ``parte`` is the share of the characters that have the class. A
    document is prose if at least half of its characters are; otherwise it has the other class with most characters,
    ties in the order list, table, junk. Repeated rows come out repeatedly; other columns are dropped.
    """
    spark = docs.sparkSession
    src = spread(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{column}`").cast("string").alias("t")))
    kind = src.schema["k"].dataType.simpleString()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, t in zip(pdf["k"], pdf["t"], strict=True):
                bs = blocks(t) if t else []
                caption = [len(b) == 1 and len(b[0]) < CAPTION and b[0][-1] not in ".!?…:»”\"" for b in bs]
                ms = [measures(b) for b in bs]
                out.append((k, *_whole(t, ms), [sum(map(len, b)) for b in bs], [m[0] for m in ms], caption))
            yield pd.DataFrame(out, columns=["k", "palabras", "largo_medio", "simbolos", "fin_puntuado", "comunes", "ns", "xs", "captions"])

    measured = cut(src.mapInPandas(measure, f"k {kind}, palabras int, largo_medio double, simbolos double, fin_puntuado double, comunes double, ns array<long>, xs array<array<double>>, captions array<boolean>"), "statistics")
    flat = cut(measured.select(F.explode(F.arrays_zip("ns", "xs")).alias("b")).select(F.col("b.ns").alias("n"), F.col("b.xs").alias("x")), "blocks")
    model, mean, sd, labels = fit(flat, rounds, pull)
    shared = spark.sparkContext.broadcast((model, mean, sd, labels))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, mu, s, names = shared.value
        onehot = np.array([[n == c for c in CLASSES] for n in names], dtype=float) if names else np.zeros((0, 4))
        for pdf in batches:
            sizes = [len(x) for x in pdf["ns"]]
            clase, parte = [None] * len(pdf), np.zeros(len(pdf))
            if sum(sizes):
                x = np.array([v for row in pdf["xs"] for v in row], dtype=object)
                x = (np.stack([np.asarray(v, float) for v in x]) - mu) / s
                best = onehot[_shares(x, m)[0].argmax(axis=1)]
                title = np.concatenate([np.asarray(v, bool) for v in pdf["captions"]])
                heads = np.concatenate([[True], np.repeat(np.arange(len(sizes)), sizes)[1:] != np.repeat(np.arange(len(sizes)), sizes)[:-1]])
                for i in np.nonzero(title[:-1] & ~heads[1:])[0]:  # the caption of a list or table is part of it
                    if best[i, 0] and (best[i + 1, 1] or best[i + 1, 2]):
                        best[i] = best[i + 1]
                best = best * np.concatenate([np.asarray(v, float) for v in pdf["ns"]])[:, None]
                at = 0
                for i, c in enumerate(sizes):
                    if c:
                        total = best[at : at + c].sum(axis=0)
                        j = 0 if total[0] * 2 >= total.sum() else 1 + int(total[1:].argmax())
                        clase[i], parte[i] = CLASSES[j], total[j] / total.sum()
                        at += c
            yield pdf[["k", "palabras", "largo_medio", "simbolos", "fin_puntuado", "comunes"]].assign(clase=clase, parte=parte.round(4))

    out = measured.mapInPandas(decide, f"k {kind}, palabras int, largo_medio double, simbolos double, fin_puntuado double, comunes double, clase string, parte double")
    return out.withColumnRenamed("k", key)
