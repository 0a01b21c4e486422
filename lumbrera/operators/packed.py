"""Several values packed in one field: choosing the delimiter-and-quote dialect of least description length.

Every field is parsed under each dialect its characters allow: any set of the delimiters it contains, with or without
regard to quotes, with or without list marks, or as a JSON array. A parse costs

* for each value, the cheaper of its code as a value known from other fields (``-log2`` of its share, counted over
  all distinct fields) and its code as a new one (its characters, plus its shape under a trigram model of token
  classes, counted over all distinct fields as well),
* a fixed price for each delimiter kind in the dialect and for each separation.

The cheapest parse wins. Counts come from the parses of the round before; the first round's are a cautious parse at
unambiguous delimiters outside quotes. Work is done once per distinct field text, so a value repeated in a third of
all rows costs no more than any other.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.plans.lineage import cut, drop, spread

#: Delimiter kinds with the pattern that splits at them and the bits that using the kind costs.
DELIMITERS = {
    "pipe": (r"\|", 1.0),
    "semicolon": (r";", 1.0),
    "newline": (r"[\r\n]+", 1.0),
    "tab": (r"\t", 1.0),
    "slashes": (r"\s//\s", 2.0),
    "slash": (r"(?<!/)\s?/\s?(?!/)", 4.0),
    "ampersand": (r"\s&\s", 3.0),
    "and": (r"\s[ye]\s", 5.0),
    "comma": (r"(?<=\")\s*,\s*(?=\")", 2.0),
}
#: Kinds whose characters hardly occur in values: the cautious parse splits at them.
CAUTIOUS = ("pipe", "semicolon", "newline", "tab", "comma")
#: Bits of a new value besides its shape, of each of its characters, and of one separation.
NEW, CHAR, SEPARATION = 6.0, 2.5, 1.0
_MARK = re.compile(r"(?:^|(?<=\s))\(?(\d{1,3})[.)]\s+(?=\S)")
_TOKEN = re.compile(r"\d+|[^\W\d_]+(?:['’][^\W\d_]+)*\.?|\s+|.", re.S)
_PARTICLES = {"de", "del", "la", "las", "los", "da", "do", "dos", "van", "von", "di"}
#: A field without any of these holds one value as it stands.
_SUSPECT = r'[|;/&\n\r\t"\[\]]|\s[ye]\s|(^|\s)\(?\d{1,3}[.)]\s'


def shape(value: str) -> str:
    """Token classes of a value: W capitalised, U upper case, w lower case, i initial or abbreviation, p particle,
    y a joining word, n number; blanks between words are left out, other characters stand for themselves."""
    out = []
    for t in _TOKEN.findall(value):
        if t.isspace():
            if t != " ":
                out.append("s")
        elif t[0].isdigit():
            out.append("n")
        elif t[0].isalpha():
            low = t.lower()
            if low in ("y", "e"):
                out.append("y")
            elif low in _PARTICLES:
                out.append("p")
            elif t.endswith("."):
                out.append("i")
            elif t.isupper():
                out.append("U")
            else:
                out.append("W" if t[0].isupper() else "w")
        else:
            out.append(t if t in ",|;/&\"'()[]-.…" else "o")
    return "".join(out)


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    """Spans in double quotes that open at a value's start and close at a value's end; "" and \\" stay inside."""
    spans, i = [], 0
    while (i := text.find('"', i)) >= 0:
        before = text[:i].rstrip(" ")
        if before and before[-1] not in "|;/&,\n\r\t[" and not re.search(r"\s[ye]$|\d[.)]$", before):
            i += 1
            continue
        j = i + 1
        while True:
            j = text.find('"', j)
            if j < 0:
                return spans
            if text[j - 1] == "\\" and j - 1 > i:
                j += 1
            elif text[j + 1 : j + 2] == '"':
                j += 2
            else:
                break
        after = text[j + 1 :].lstrip(" ")
        if not after or after[0] in "|;/&,\n\r\t]" or re.match(r"[ye]\s|\(?\d{1,3}[.)]\s", after):
            spans.append((i, j + 1))
            i = j + 1
        else:
            i += 1
    return spans


def _bare(value: str, quotes: bool) -> str:
    value = value.strip()
    if quotes and len(value) >= 2 and value[0] == value[-1] == '"':
        value = value[1:-1].replace('\\"', '"').replace('""', '"').strip()
    return value


def parse(text: str, kinds: tuple[str, ...], quotes: bool, marks: bool) -> list[str]:
    """Values of a field under one dialect, empty ones left out."""
    spans = _quoted_spans(text) if quotes else []
    cuts = []
    if marks:
        cuts += [(m.start(), m.end()) for m in _marks(text)]
    for kind in kinds:
        cuts += [m.span() for m in re.finditer(DELIMITERS[kind][0], text)]
    out, at = [], 0
    for a, b in sorted(cuts):
        if a < at or any(s < b and a < e for s, e in spans):
            continue
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return [v for v in (_bare(x, quotes) for x in out) if v]


def _marks(text: str) -> list[re.Match]:
    """List marks, if they begin the field and count up from 1."""
    found = list(_MARK.finditer(text))
    run = [m for k, m in enumerate(found) if int(m[1]) == k + 1]
    return run if len(run) > 1 and len(run) == len(found) and not text[: run[0].start()].strip(" |;/\"") else []


def dialects(text: str) -> list[tuple[str, float, list[str]]]:
    """(name, bits, values) for every dialect that the characters of a field allow; the first leaves it whole."""
    quotes = (False, True) if '"' in text else (False,)
    present = [k for k, (p, _) in DELIMITERS.items() if re.search(p, text)]
    marks = (False, True) if _marks(text) else (False,)
    out, seen = [], set()
    for n in range(len(present) + 1):
        for kinds in combinations(present, n):
            for q in quotes:
                for m in marks:
                    values = parse(text, kinds, q, m)
                    bits = sum(DELIMITERS[k][1] for k in kinds) + SEPARATION * max(0, len(values) - 1) + q + m
                    if tuple(values) not in seen:
                        seen.add(tuple(values))
                        out.append(("+".join((*kinds, *("quote",) * q, *("mark",) * m)) or "whole", bits, values))
    if text.lstrip()[:1] == "[" and text.rstrip()[-1:] == "]":
        try:
            values = [x.strip() for x in json.loads(text) if isinstance(x, str)]
        except ValueError:
            values = [_bare(x, True) for x in parse(text.strip()[1:-1], ("comma",), True, False)]
        out.append(("json", 2.0 + SEPARATION * max(0, len(values) - 1), [x for x in values if x]))
    return out


def cautious(text: str) -> list[str]:
    """The first round's parse: unambiguous delimiters outside quotes, JSON arrays and list marks."""
    if text[:1] == "[" and text[-1:] == "]":
        return next((v for name, _, v in reversed(dialects(text)) if name == "json"), [text])
    return parse(text, CAUTIOUS, True, bool(_marks(text)))


def shape_bits(shapes: dict[str, int]) -> dict[str, float]:
    """-log2 of the trigram probabilities of token classes, and their backoff; keys are classes after two others."""
    tri: Counter = Counter()
    for s, n in shapes.items():
        tri[s] += n
    context: Counter = Counter()
    for g, n in tri.items():
        context[g[:2]] += n
    bits = {g: -log2((n + 0.05) / (context[g[:2]] + 2.0)) for g, n in tri.items()}
    bits |= {c + "\0": -log2(0.05 / (n + 2.0)) for c, n in context.items()}
    return bits


def _new_bits(value: str, bits: dict[str, float]) -> float:
    s = "^^" + shape(value) + "$"
    return NEW + CHAR * len(value) + sum(bits.get(s[i : i + 3], bits.get(s[i : i + 2] + "\0", 6.0)) for i in range(len(s) - 2))


def split_packed(df: DataFrame, columns: list[str], key: str, rounds: int = 2) -> DataFrame:
    """(key, campo, posicion, valor, n): one row for each value of each named column, n being the field's values.

    Null fields, and fields of white space or delimiters alone, give no row. A field with one value gives that value
    with position 1. Repeated rows come out repeatedly; positions count from 1 over non-empty values; ties between
    dialects go to the one with fewer delimiter kinds. Columns not named are dropped, whatever their names.
    """
    fields = df.select(F.col(f"`{key}`").alias("k"), F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])).alias("f")).select("k", "f.campo", "f.v")
    fields = fields.where(F.col("v").isNotNull() & F.col("v").rlike(r"\S"))
    texts = cut(fields.select("v").distinct().withColumn("suspect", F.col("v").rlike(_SUSPECT)), "packed-texts")
    suspects = cut(spread(texts.where("suspect").select("v")).withColumn("id", F.monotonically_increasing_id()), "packed-suspects")
    plain = texts.where("NOT suspect").select(F.trim("v").alias("value"))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "vals": pd.Series([cautious(v) for v in pdf["v"]], dtype=object, index=pdf.index)})

    parsed = cut(suspects.mapInPandas(first, "id long, vals array<string>"), "packed-0")
    for r in range(rounds):
        parsed, old = cut(_round(suspects, parsed, plain), f"packed-{r + 1}"), parsed
        drop(old)
    whole = texts.where("NOT suspect").select("v", F.array(F.regexp_replace("v", r"^\s+|\s+$", "")).alias("vals"))
    chosen = suspects.join(parsed, "id").select("v", "vals").unionByName(whole)
    out = fields.join(chosen, "v").select(F.col("k").alias(key), "campo", F.posexplode("vals").alias("p", "valor"), F.size("vals").alias("n"))
    return out.select(key, "campo", (F.col("p") + 1).alias("posicion"), "valor", "n")


def _round(suspects: DataFrame, parsed: DataFrame, plain: DataFrame) -> DataFrame:
    """Counts values and shapes of the parses so far over all distinct fields, and parses every field anew."""
    spark = suspects.sparkSession
    singles = plain.select("value").unionByName(parsed.select(F.explode("vals").alias("value")))

    def trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: Counter = Counter()
        for pdf in batches:
            for v in pdf["value"]:
                s = "^^" + shape(v) + "$"
                out.update(s[i : i + 3] for i in range(len(s) - 2))
        if out:
            yield pd.DataFrame({"g": list(out), "n": list(out.values())})

    # At most (token classes)^3 rows reach the driver: 31 classes, so fewer than 30,000.
    grams = singles.mapInPandas(trigrams, "g string, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    bits = spark.sparkContext.broadcast(shape_bits(dict(zip(grams["g"], grams["n"], strict=True))))
    known = singles.groupBy("value").agg(F.count("*").alias("c"))
    total = max(2, texts_count(singles))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, v in zip(pdf["id"], pdf["v"], strict=True):
                for k, (_, extra, values) in enumerate(dialects(v)):
                    rows += [(i, k, extra, at, x, _new_bits(x, bits.value)) for at, x in enumerate(values)] or [(i, k, extra, 0, "", 0.0)]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "d", "extra", "at", "value", "fresh"])

    cands = suspects.mapInPandas(candidates, "id long, d int, extra double, at int, value string, fresh double")
    # A value counts as known by the other distinct fields that hold it: one field is taken off.
    code = F.when(F.col("c") > 1, F.least(F.col("fresh"), F.log2(F.lit(float(total)) / (F.col("c") - 1)) + 1.0)).otherwise(F.col("fresh"))
    costs = cands.join(known, "value", "left").groupBy("id", "d").agg((F.sum(code) + F.first("extra")).alias("cost"), F.sort_array(F.collect_list(F.struct("at", "value"))).alias("a"))
    best = costs.groupBy("id").agg(F.min_by(F.struct("a"), F.struct(F.round("cost", 6), "d")).alias("b"))
    return best.select("id", F.filter(F.transform("b.a", lambda x: x["value"]), lambda x: x != "").alias("vals"))


def texts_count(values: DataFrame) -> int:
    return values.count()
