"""Free entries mapped to a reference list by a symmetric-delete dictionary.

Each reference entry has a few written forms (canonical, display, acronym), normalised: plain lower-case letters,
abbreviated heads spelled out, the home institution's name and joining words dropped. What the heads, joining words and
the home's names are is learned from the list and the column themselves. All strings reached from a form by deleting up
to ``edits`` characters are keys of one dictionary; an entry typed with up to ``edits`` errors shares a key with its
form. What the keys propose is ranked by weighted Damerau-Levenshtein distance, then by how often the reference entry is
used in the column, then by id. Everything else is reported as a miss. The dictionary is built and broadcast only if a
bound on its size, computed from the lengths of the forms, stays below a limit; beyond it, the same keys are joined.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.plans.lineage import cut, spread


@dataclass(frozen=True)
class Vocabulary:
    """What is known of the list's world, as data: all lower case, without accents. learn() finds it.

    home: names of the institution that all entries belong to, as tuples of words; heads: first words of entries;
    stop: joining words; synonyms: (words put before what distinguishes an entry, the list's own words for them)."""

    home: tuple[tuple[str, ...], ...] = ()
    heads: tuple[str, ...] = ()
    stop: frozenset = frozenset()
    synonyms: tuple[tuple[str, str], ...] = ()


#: Entries of the list that must show the same: a word that is joining or a last word of all, a phrase that replaces a head.
SHARED, SHOWN = 0.9, 3
#: Learned phrases of each kind at most, the commonest first.
PHRASES = 500
#: Edits allowed for strings of at least so many characters; dictionary keys that may be broadcast.
EDITS = ((12, 2), (6, 1), (0, 0))
BROADCAST_KEYS = 2_000_000
#: Prices of edits: what hands and scanners confuse costs less.
_ALIKE = {frozenset(p) for p in ("o0", "l1", "i1", "e3", "a4", "s5", "s$", "b8", "g9", "cs", "sz", "bv", "gj", "yi", "nm", "uv")}


def plain(text: str) -> str:
    """Lower case without accents; everything but letters and digits becomes a blank, dots between initials vanish."""
    text = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    text = re.sub(r"(?<=\b[a-z])\.(?=[a-z]\b)", "", text)
    return " ".join(re.findall(r"[a-z0-9]+", text))


def head_of(word: str, vocab: Vocabulary) -> str:
    """The head that a word of up to four letters abbreviates: it has the first letter and all others in order, and no
    other head has."""
    if word in vocab.heads or len(word) > 4:
        return word

    def follows(h: str) -> bool:
        it = iter(h)
        return h[0] == word[0] and all(c in it for c in word)

    may = [h for h in vocab.heads if follows(h)]
    return may[0] if len(may) == 1 else word


def bare(text: str, vocab: Vocabulary, stops: bool = False) -> list[str]:
    """The words of a text without the home's names and, unless ``stops``, without joining words."""
    words = plain(text).split()
    for phrase in vocab.home:
        at = [i for i, w in enumerate(words) if w not in vocab.stop or w in phrase]
        hit = next((k for k in range(len(at) - len(phrase) + 1) if tuple(words[i] for i in at[k : k + len(phrase)]) == phrase), None)
        if hit is not None:
            words = words[: at[hit]] + words[at[hit + len(phrase) - 1] + 1 :]
    return [w for w in words if stops or w not in vocab.stop]


def normal(text: str, vocab: Vocabulary, stops: bool = False) -> str:
    """The comparable form of an entry or of a reference value; ``stops`` keeps the joining words (in which there may
    be errors as well)."""
    words = bare(text, vocab, stops)
    if words:
        words[0] = head_of(words[0], vocab)
    t = " ".join(words)
    for a, b in vocab.synonyms:
        if t.startswith(a + " "):
            t = b + t[len(a) :]
            break
    words = t.split()
    if len(words) > 1 and words[-1] in vocab.heads and words[0] not in vocab.heads:
        words = [words[-1], *words[:-1]]  # the head was put last
    return " ".join(words)


def learn(ref: DataFrame, main: str, values: DataFrame) -> Vocabulary:
    """The vocabulary of a list ``ref`` (r, and its column ``main``) and of the distinct values (v) mapped to it.

    A word that SHARED of the entries end with names the home, and so does a phrase with these initials that stands
    beside an entry's words. First words are heads; words of up to three letters within SHOWN entries or more, never
    first, are joining words. Words that stand before what distinguishes SHOWN entries of one beginning, and are no
    beginning of the list's own, stand for it. Values longer than twice the longest entry can't show any of this."""
    split = lambda c: F.udf(lambda t: plain(t or "").split(), "array<string>")(c)  # noqa: E731  (the list's entries only)
    entries = cut(ref.where(F.col(main).isNotNull()).select("r", split(F.col(main)).alias("w")).where(F.size("w") > 0), "reference-words")
    size = entries.agg(F.count("*").alias("n"), F.max(F.size("w")).alias("longest")).collect()[0]
    if not size["n"]:
        return Vocabulary()
    tails = entries.where(F.size("w") > 1).groupBy(F.element_at("w", -1).alias("w")).count().where(F.col("count") >= SHARED * size["n"]).collect()  # one at most
    home = tuple((r["w"],) for r in tails)
    firsts = entries.where(F.size("w") > 1).groupBy(F.col("w")[0].alias("w")).count()
    heads = tuple(sorted(r["w"] for r in firsts.orderBy(F.desc("count"), "w").limit(PHRASES).collect()))
    inner = entries.select("r", F.explode(F.slice("w", 2, size["longest"])).alias("w")).where(F.length("w") <= 3).groupBy("w").agg(F.countDistinct("r").alias("c")).join(firsts.select("w"), "w", "left_anti")
    stop = frozenset(r["w"] for r in inner.where(F.col("c") >= min(SHOWN, size["n"])).orderBy(F.desc("c"), "w").limit(PHRASES).collect()) - {h[0] for h in home}
    stop |= frozenset(r["w"] for r in entries.select("r", F.explode("w").alias("w")).where(F.length("w") <= 2).groupBy("w").agg(F.countDistinct("r").alias("c")).where("c > 1").join(firsts.select("w"), "w", "left_anti").orderBy(F.desc("c"), "w").limit(PHRASES).collect())
    known = Vocabulary(home, heads, stop)
    most = 2 * size["longest"] + 2

    def splits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for v in pdf["v"]:
                w = bare(v, known) if len(v) < 40 * most else []
                if 1 < len(w) <= most:
                    rows += [(" ".join(w[:i]), " ".join(w[i:])) for i in range(1, len(w))]
            if rows:
                yield pd.DataFrame(rows, columns=["left", "right"])

    halves = cut(spread(values.select("v")).mapInPandas(splits, "left string, right string").distinct(), "halves")
    forms = entries.select("r", F.array_join("w", " ").alias("v")).mapInPandas(lambda it: (pd.DataFrame({"r": p["r"], "text": [" ".join(bare(v, known)) for v in p["v"]]}) for p in it), "r int, text string")
    named: list[tuple[str, ...]] = []
    if home:
        beside = halves.join(forms.select(F.col("text").alias("left"), "r"), "left").select(F.col("right").alias("p"), "r")
        beside = beside.unionByName(halves.join(forms.select(F.col("text").alias("right"), "r"), "right").select(F.col("left").alias("p"), "r"))
        initials = F.array_join(F.transform(F.split("p", " "), lambda w: F.substring(w, 1, 1)), "")
        found = beside.where(F.col("p").contains(" ") & initials.isin([h[0] for h in home])).groupBy("p").agg(F.countDistinct("r").alias("c"))
        named = [tuple(r["p"].split()) for r in found.orderBy(F.desc("c"), "p").limit(PHRASES).collect()]
    cuts = forms.where(F.col("text") != "").select("r", F.split("text", " ").alias("w")).select("r", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1)))).alias("i")).where(F.size("w") > 1)
    cuts = cut(cuts.select("r", F.array_join(F.slice("w", 1, F.col("i")), " ").alias("own"), F.array_join(F.expr("slice(w, i + 1, size(w))"), " ").alias("right")), "beginnings")
    shared = cuts.groupBy("own").agg(F.countDistinct("r").alias("c")).where(F.col("c") >= SHOWN).select("own")
    told = halves.join(cuts.join(shared, "own"), "right").join(cuts.select(F.col("own").alias("left")).distinct(), "left", "left_anti")
    told = told.groupBy("left", "own").agg(F.countDistinct("r").alias("c")).where(F.col("c") >= SHOWN)
    best = Window.partitionBy("left").orderBy(F.desc("c"), F.desc(F.length("own")), "own")
    found = told.withColumn("k", F.row_number().over(best)).where("k = 1").orderBy(F.desc("c"), "left").limit(PHRASES).collect()
    synonyms = tuple(sorted(((r["left"], r["own"]) for r in found), key=lambda x: (-len(x[0]), x)))
    return Vocabulary((*sorted(named, key=lambda p: (-len(p), p)), *home), heads, stop, synonyms)


def allowed(text: str, edits=EDITS) -> int:
    return next(e for n, e in edits if len(text) >= n)


def deletes(text: str, edits: int) -> set[str]:
    """All strings left when up to ``edits`` characters are deleted."""
    out, front = {text}, {text}
    for _ in range(edits):
        front = {t[:i] + t[i + 1 :] for t in front for i in range(len(t))}
        out |= front
    return out


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein distance (adjacent swaps 0.8, look-alikes 0.6, doubled letters 0.7, the first
    letter 1.3); infinity beyond ``most``."""
    if abs(len(a) - len(b)) > most / 0.6:
        return float("inf")
    before, row = None, [float(j) for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        new = [float(i)] + [0.0] * len(b)
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            swap = 0.0 if x == y else 0.6 if frozenset((x, y)) in _ALIKE else 1.3 if i == j == 1 else 1.0
            drop = 0.7 if i > 1 and a[i - 2] == x else 1.0
            add = 0.7 if j > 1 and b[j - 2] == y else 1.0
            new[j] = min(row[j - 1] + swap, row[j] + drop, new[j - 1] + add)
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                new[j] = min(new[j], before[j - 2] + 0.8)
        before, row = row, new
        if min(row) > most and min(before) > most:
            return float("inf")
    return row[-1] if row[-1] <= most else float("inf")


def map_entries(df: DataFrame, key: str, column: str, reference: DataFrame, ref_id: str, ref_texts: list[str], vocab: Vocabulary | None = None, edits=EDITS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(key, valor, ref_id, distancia) for every row whose value isn't null or empty: the reference entry meant, or
    ref_id 0 and null distance where the list has none. Letter-for-letter entries have distance 0.

    Equal values get equal answers; each distinct value is looked up once. A value of blanks or signs alone is a miss,
    and so is an acronym or word of fewer than six letters with an error in it. A form that several entries share means
    none of them. An empty reference list makes every value a miss. Columns not named are dropped. Without ``vocab`` it
    is learned.
    """
    spark = df.sparkSession
    cells = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{column}`").cast("string").alias("v")).where("v IS NOT NULL AND v <> ''")
    values = cut(cells.groupBy("v").agg(F.count("*").alias("n")), "entries")
    ref = cut(reference.select(F.col(f"`{ref_id}`").cast("int").alias("r"), *[F.col(f"`{c}`").cast("string").alias(f"t{i}") for i, c in enumerate(ref_texts)]).where("r IS NOT NULL"), "reference")
    texts = [f"t{i}" for i in range(len(ref_texts))]
    known = learn(ref, "t0", values) if vocab is None else vocab
    used = ref.select("r", F.explode(F.array(*texts)).alias("v")).distinct().join(values, "v").groupBy("r").agg(F.sum("n").alias("n"))

    def readings(v: str) -> list[str]:
        return [t for t in dict.fromkeys((normal(v, known), normal(v, known, True))) if t]

    def formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r, f) for r, *ts in pdf.itertuples(index=False) for f in {f for t in ts if t for f in readings(t)}]
            yield pd.DataFrame(rows, columns=["r", "f"]).astype({"r": "int32", "f": str})

    forms = ref.mapInPandas(formed, "r int, f string").groupBy("f").agg(F.min("r").alias("r"), F.max("r").alias("other")).where("r = other")
    forms = cut(forms.select("f", "r").join(used, "r", "left").select("f", "r", F.coalesce("n", F.lit(0)).alias("n")), "forms")
    exact = ref.where("t0 <> ''").groupBy(F.col("t0").alias("v")).agg(F.min("r").alias("exact"))
    asked = cut(values.select("v").join(exact, "v", "left").select("v", "exact"), "asked")

    def rank(v: str, options) -> tuple[str, int, float | None]:
        best = None
        for text in readings(v):
            for f, r, n in options:
                most = min(allowed(text, edits), allowed(f, edits)) + 0.3
                d = distance(text, f, most)
                if d <= most:
                    cand = (round(d, 3), -n, r)
                    best = cand if best is None or cand < best else best
        return (v, best[2], best[0]) if best else (v, 0, None)

    length = F.length("f")
    reach = F.lit(0)
    for least, e in sorted(edits):  # strings that up to e deletions can leave
        reach = F.when(length >= least, sum((_choose(length, j) for j in range(1, e + 1)), F.lit(1.0))).otherwise(reach)
    bound = forms.agg(F.sum(reach).alias("keys")).collect()[0]["keys"] or 0
    near = asked.where("exact IS NULL").select("v")
    if bound <= broadcast_keys:
        table: dict[str, list[tuple[str, int, int]]] = {}
        for r in forms.collect():  # fewer than the keys that the bound allows
            for d in deletes(r["f"], allowed(r["f"], edits)):
                table.setdefault(d, []).append((r["f"], r["r"], r["n"]))
        table_b = spark.sparkContext.broadcast(table)

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = [rank(v, {f for t in readings(v) for d in deletes(t, allowed(t, edits)) for f in table_b.value.get(d, ())}) for v in pdf["v"]]
                yield pd.DataFrame(out, columns=["v", "r", "d"]).astype({"r": "int32", "d": float})

        answers = spread(near).mapInPandas(look, "v string, r int, d double")
    else:
        keys = spread(forms).mapInPandas(lambda it: (pd.DataFrame([(d, f, r, n) for f, r, n in zip(p["f"], p["r"], p["n"]) for d in deletes(f, allowed(f, edits))], columns=["d", "f", "r", "n"]) for p in it), "d string, f string, r int, n long")
        spelt = spread(near).mapInPandas(lambda it: (pd.DataFrame([(v, d) for v in p["v"] for t in readings(v) for d in deletes(t, allowed(t, edits))], columns=["v", "d"]) for p in it), "v string, d string")
        met = spelt.join(keys, "d").groupBy("v").agg(F.collect_set(F.struct("f", "r", "n")).alias("fs"))
        met = near.join(met, "v", "left").select("v", F.coalesce("fs", F.array().cast("array<struct<f:string,r:int,n:bigint>>")).alias("fs"))
        answers = met.mapInPandas(lambda it: (pd.DataFrame([rank(v, [(x["f"], x["r"], x["n"]) for x in fs]) for v, fs in zip(p["v"], p["fs"])], columns=["v", "r", "d"]).astype({"r": "int32", "d": float}) for p in it), "v string, r int, d double")
    same = asked.where("exact IS NOT NULL").select("v", F.col("exact").alias("r"), F.lit(0.0).alias("d"))
    answers = cut(answers.unionByName(same), "answers")
    return cells.join(answers, "v").select(F.col("k").alias(key), F.col("v").alias("valor"), F.col("r").alias(ref_id), F.nullif(F.col("d"), F.lit(float("nan"))).alias("distancia"))


def _choose(n, k: int):
    out = F.lit(1.0)
    for i in range(k):
        out = out * (n - i) / (i + 1)
    return out
