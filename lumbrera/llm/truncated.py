"""Values cut off by a field limit or in transfer: hashed logistic regression trained on cuts made on purpose.

Intact values of a bounded sample are cut, at random places and at the length limits that the histogram of lengths
betrays, which makes positives; the same values whole are negatives. Features are hashed: the closing characters, the
shape and punctuation of the last part, what other values know of the last word, the length against the limits of the
record's source, and what companion columns still hold. Scores cover every record. The share of cut values differs
from the training sample's, so it is estimated from all scores (by expectation-maximization over their histogram)
before the threshold of one half is applied.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.operators.packed import shape
from lumbrera.plans.lineage import cut, spread

#: Intact values cut for training, at most; hashed weights; a length is a limit from so many
#: values, and so many times its neighbours; rounds in which values found cut leave the negatives; limits a value draws.
SAMPLE, SLOTS, LIMIT_VALUES, LIMIT_FACTOR, PASSES, DRAWS = 30_000, 1 << 16, 12, 3.0, 3, 16
_PART = re.compile(r"\s[ye&/]\s|\s//\s|[|;\n\r\t]|(?<=\")\s*,\s*(?=\")")
_WORD = re.compile(r"[^\s,|;/&\"()\[\].…]+\.?")


def features(v: str, known: int, at_chars: bool, at_bytes: bool, near: bool, held: int, first: int) -> list[str]:
    """Names of the features of a value. known: how often its last word stands inside other values; at_chars,
    at_bytes, near: its length is a limit of its source, or just below one; held: letters more in the display column;
    first: whether the principal column goes on where the value ends."""
    end = v.rstrip()
    parts = [p for p in _PART.split(end) if p.strip()]
    last = parts[-1].strip() if parts else ""
    words = _WORD.findall(last)
    word = words[-1] if words else ""
    ch = end[-1:] or " "
    kind = "L" if ch.isalpha() else "9" if ch.isdigit() else ch
    commas = sum("," in p for p in parts[:-1])
    side = "g" if "," in last else "s"
    level = 0 if known == 0 else 1 if known < 3 else 2 if known < 10 else 3
    given = len(_WORD.findall(last.partition(",")[2]))
    limit = f"{int(at_chars)}{int(at_bytes)}{int(near)}"
    s = shape(last)
    out = [
        "bias", f"end={kind}", f"end3={end[-3:].lower()}", f"end2={end[-2:].lower()}", f"word_end={word[-1:].lower()}",
        f"shape={s}", f"shape_end={s[-3:]}|{side}", f"comma={side}{min(commas, 1)}{min(len(parts), 3)}", f"given={min(given, 3)}{side}",
        f"known={level}{side}", f"known_given={level}{min(given, 3)}", f"word_len={min(len(word), 12)}{side}", f"short={min(len(word), 4)}{level}{side}",
        f"limit={limit}", f"limit_end={limit}{kind}", f"limit_known={limit}{level}{side}", f"parts={min(len(parts), 4)}",
        f"quotes={end.count(chr(34)) % 2}", f"open={end.count('(') - end.count(')')}{end.count('[') - end.count(']')}",
        f"dots={end.endswith(('…', '...'))}", f"hanging={bool(re.search(r'[,|;/&]$', end))}", f"held={max(-1, min(held, 3))}", f"held_known={max(-1, min(held, 3))}{level}", f"first={first}",
        f"singles={len(words)}{len(parts) == 1}",
    ]
    return out


def slots(names: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(n.encode()) % SLOTS for n in names], dtype=np.int64)


def train(rows: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.15, ridge: float = 1e-5) -> np.ndarray:
    """Weights of a logistic regression over rows of slots (equally many each), by Adagrad in a fixed order; the mean
    over the second half of the epochs, which hangs less on the order."""
    w, g2, mean = np.zeros(SLOTS), np.full(SLOTS, 1e-6), np.zeros(SLOTS)
    rng = np.random.default_rng(7)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 128):
            i = order[k : k + 128]
            p = 1 / (1 + np.exp(-w[rows[i]].sum(axis=1)))
            g = np.repeat((p - y[i]) / len(i), rows.shape[1])
            at = rows[i].ravel()
            total = np.bincount(at, g, minlength=0)
            touched = np.nonzero(total)[0]
            step = total[touched] + ridge * w[touched]
            g2[touched] += step * step
            w[touched] -= rate * step / np.sqrt(g2[touched])
        if epoch >= epochs // 2:
            mean += w
    return mean / (epochs - epochs // 2)


def prior(bins: np.ndarray, counts: np.ndarray, trained: float = 0.5) -> float:
    """Share of positives among all records, from the histogram of their logits under a model trained at ``trained``."""
    p = 1 / (1 + np.exp(-np.clip(bins, -30, 30)))
    share = 0.05
    for _ in range(200):
        a, b = p * share / trained, (1 - p) * (1 - share) / (1 - trained)
        new = float(np.dot(counts, a / (a + b)) / max(1, counts.sum()))
        if abs(new - share) < 1e-7:
            break
        share = min(max(new, 1e-6), 0.9)
    return share


def _last_word(v: Column) -> Column:
    return F.lower(F.regexp_extract(v, r'([^\s,|;/&"()\[\].…]+)[\s,|;/&"()\[\].…]*$', 1))


def _core(v: str) -> Column:
    """A value without the dots that mark a cut: its length is held against limits."""
    return F.regexp_replace(F.col(v), r"\s*(…|\.\.\.)$", "")


def _limits(lengths: DataFrame, distinct: DataFrame) -> DataFrame:
    """(origen, unit, size, natural): lengths at which a source stops, with the share of values of that length that
    would be expected without a limit.

    The last limit of a source stands out from the lengths just below it and little exceeds it; damage after the cut (a
    space trimmed, a letter recoded) spreads it a little, so the commonest one counts. Any other field limit stands out,
    among different values, from the lengths on both sides."""
    near = Window.partitionBy("origen", "unit").orderBy("size")

    def wide(rows: DataFrame) -> DataFrame:
        hist = rows.groupBy("origen", "unit", "size").agg(F.count("*").alias("c"))  # a row a length, whatever the number of values
        below = F.coalesce(F.sum("c").over(near.rangeBetween(-4, -1)), F.lit(0)) / 4.0
        return hist.withColumn("below", below).withColumn("next", F.coalesce(F.sum("c").over(near.rangeBetween(1, 4)), F.lit(0)) / 4.0).withColumn("above", F.coalesce(F.sum("c").over(near.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))

    out = (F.col("c") >= LIMIT_VALUES) & (F.col("c") > LIMIT_FACTOR * (F.col("below") + 1))
    natural = (F.col("below") / F.col("c")).alias("natural")
    last = wide(lengths).where(out & (F.col("above") < F.col("c"))).groupBy("origen", "unit").agg(F.max_by(F.struct("size", natural), F.struct("c", "size")).alias("x")).select("origen", "unit", "x.size", "x.natural")
    inner = wide(distinct).where(out & (F.col("c") > LIMIT_FACTOR * (F.col("next") + 1)) & (F.col("above") >= F.col("c"))).select("origen", "unit", "size", natural)
    return last.unionByName(inner.join(last.select("origen", "unit", "size"), ["origen", "unit", "size"], "left_anti"))


def find_truncated(df: DataFrame, key: str, column: str, source: str, display: str | None = None, principal: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """(key, origen, valor, score, cut): every non-empty value with the probability that it was cut off.

    Null, empty and blank values give no row; a null source is a source of its own (""). Repeated rows are scored
    alike. With no rows, or too few to train on, nothing is reported as cut. Only the training uses a sample: at most
    ``sample`` values, those of smallest hash.
    """
    spark = df.sparkSession
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c else F.lit("")
    base = df.select(F.col(f"`{key}`").alias("k"), text(source).alias("origen"), text(column).alias("v"), text(display).alias("d"), text(principal).alias("p")).where(F.col("v").rlike(r"\S"))
    letters = lambda c: F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    first = F.when((F.length("p") > F.length("v")) & F.col("p").startswith(F.col("v")), 2).when(F.col("p") == F.col("v"), 1).otherwise(0)
    held = F.when(F.col("d") == "", -1).otherwise(F.greatest(F.lit(0), F.least(F.lit(3), letters("d") - letters("v"))))
    base = cut(spread(base.select("k", "origen", "v", held.cast("int").alias("held"), first.cast("int").alias("first"))), "values")
    sizes = lambda d: d.select("origen", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.length(_core("v")).alias("size")), F.struct(F.lit("b").alias("unit"), F.octet_length(_core("v")).alias("size")))).alias("s")).select("origen", "s.unit", "s.size")
    limits = cut(_limits(sizes(base), sizes(base.select("origen", "v").distinct())), "limits")
    of = lambda u: F.collect_set(F.when(F.col("unit") == u, F.col("size")))  # noqa: E731  (few limits a source and unit)
    wide = limits.groupBy("origen").agg(of("c").alias("lc"), of("b").alias("lb"), F.max("natural").alias("natural"))
    inner = base.select("v").distinct().select(F.explode(F.filter(F.split(F.lower(F.regexp_replace("v", r'[^\s,|;/&"()\[\].…]+[\s,|;/&"()\[\].…]*$', "")), r'[\s,|;/&"()\[\].…]+'), lambda x: x != "")).alias("w"))
    known = cut(inner.groupBy("w").agg(F.count("*").alias("known")), "known-words")

    def prepared(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("w", _last_word(F.col("v"))).join(known, "w", "left").join(wide, "origen", "left")
        at = lambda n, c: F.coalesce(F.array_contains(c, n), F.lit(False))
        chars, size = F.length(_core("v")), F.octet_length(_core("v"))
        near = F.coalesce(F.exists("lc", lambda x: chars.between(x - 2, x - 1)), F.lit(False)) | F.coalesce(F.exists("lb", lambda x: size.between(x - 2, x - 1)), F.lit(False))
        return out.select(*rows.columns, F.coalesce("known", F.lit(0)).alias("known"), at(chars, "lc").alias("ac"), at(size, "lb").alias("ab"), near.alias("near"), F.coalesce("natural", F.lit(0.0)).alias("natural"))

    def rows_of(pdf: pd.DataFrame) -> np.ndarray:
        return np.array([slots(features(*x)) for x in zip(pdf["v"], pdf["known"], pdf["ac"], pdf["ab"], pdf["near"], pdf["held"], pdf["first"], strict=True)]) if len(pdf) else np.zeros((0, 1), np.int64)

    chosen = cut(base.orderBy(F.xxhash64("k", "v"), "k").limit(sample), "training-values")
    dice = lambda n, seed: F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(n))
    apart = chosen.withColumn("held", F.when(dice(2, 1) == 0, F.lit(0)).otherwise(F.when(F.col("held") < 0, -1).otherwise(3))).withColumn("first", F.when(dice(2, 1) == 0, F.lit(1)).otherwise(F.lit(2)))
    apart = apart.withColumn("first", F.when(F.col("v").rlike(r"[|;/\t\n]"), 0).otherwise(F.col("first")))
    n = F.length("v")
    at_random = apart.where((n > 8) & (dice(10, 2) < 6)).withColumn("to", F.greatest(F.lit(5), (n * (F.lit(0.25) + dice(75, 3) / 100.0)).cast("int")))
    hanging = F.regexp_extract("v", r"^(.{4,}(?:,|\s[|;/&]|;))\s*\S", 1)
    at_random = at_random.withColumn("v", F.concat(F.rtrim(F.expr("substring(v, 1, to)")), F.when(dice(8, 4) == 0, "…").when(dice(8, 4) == 1, "...").otherwise("")))
    # Cuts at a limit: a value too long for a source that has one, as that source would keep it. Each value draws DRAWS
    # limits, all sources alike.
    count = limits.count()
    placed = limits.select(F.col("origen").alias("o"), "unit", "size", (F.row_number().over(Window.orderBy("origen", "unit", "size")) - 1).alias("at"))  # a few rows a source
    drawn = chosen.withColumn("at", F.explode(F.array_distinct(F.array(*[F.pmod(F.xxhash64("k", F.lit(100 + i)), F.lit(max(count, 1))) for i in range(DRAWS)])))).withColumn("at", F.col("at").cast("int"))
    held_to = drawn.join(placed, "at") if count else None
    hung = apart.where((dice(6, 6) == 0) & (F.length(hanging) > 0)).withColumn("v", hanging)  # cut just behind a separator
    training = at_random.select("k", "origen", "v", "held", "first").unionByName(hung.select("k", "origen", "v", "held", "first")).withColumn("y", F.lit(1))
    if held_to is not None:
        long = held_to.where(F.when(F.col("unit") == "c", F.length("v")).otherwise(F.octet_length("v")) > F.col("size"))
        clipped = long.withColumn("v", F.when(F.col("unit") == "c", F.expr("substring(v, 1, size)")).otherwise(F.expr("make_valid_utf8(cast(substring(cast(v AS binary), 1, size) AS string))"))).withColumn("v", F.regexp_replace("v", "�$", ""))
        w = Window.partitionBy("k").orderBy(F.xxhash64("k", "o"))
        clipped = clipped.withColumn("r", F.row_number().over(w)).where("r = 1").withColumn("origen", F.col("o"))
        training = training.unionByName(clipped.withColumn("held", F.when(dice(2, 5) == 0, F.lit(0)).otherwise(F.lit(3))).select("k", "origen", "v", "held", F.lit(0).alias("first"), F.lit(1).alias("y")))
    examples = prepared(training.unionByName(chosen.select("k", "origen", "v", "held", "first", F.lit(0).alias("y")))).orderBy("k", "y", "v").toPandas()
    if len(examples) < 50 or examples["y"].nunique() < 2:
        return base.select(F.col("k").alias(key), "origen", F.col("v").alias("valor"), F.lit(0.0).alias("score"), F.lit(False).alias("cut"))
    y, x = examples["y"].to_numpy().astype(float), rows_of(examples)
    # Some values taken for intact were cut already. Of those at a limit, only as many stay negatives as would have
    # that length by nature, the least suspicious ones; of the others, those that the model takes for cut leave.
    limited = ((examples["ac"] | examples["ab"] | examples["near"]) & (examples["y"] == 0)).to_numpy()
    natural = int(np.ceil(examples["natural"].to_numpy()[limited & (examples["ac"] | examples["ab"]).to_numpy()].sum()))
    open_end = (examples["v"].str.contains(r"(?:[,|;/&…]|\.\.\.)\s*$") & (examples["y"] == 0)).to_numpy()  # not known to be whole
    keep = ~limited & ~open_end
    for _ in range(PASSES):
        weights = train(x[keep], y[keep])
        z = weights[x].sum(axis=1)
        keep = (y == 1) | ((z < 0) & ~limited & ~open_end)
        keep[np.nonzero(limited)[0][np.argsort(z[limited], kind="stable")[:natural]]] = True
    trained = float(y[keep].mean())
    shared = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = rows_of(pdf)
            yield pdf[["k", "origen", "v"]].assign(z=shared.value[x].sum(axis=1) if len(pdf) else [])

    kind = base.schema["k"].dataType.simpleString()
    scored = cut(prepared(base).mapInPandas(score, f"k {kind}, origen string, v string, z double"), "scored")
    hist = scored.groupBy(F.round(F.least(F.lit(20), F.greatest(F.lit(-20), F.col("z"))), 1).alias("z")).agg(F.count("*").alias("c")).toPandas()  # at most 401 rows
    share = prior(hist["z"].to_numpy(), hist["c"].to_numpy(), trained)
    shift = float(np.log(share / (1 - share)) - np.log(trained / (1 - trained)))
    p = 1 / (1 + F.exp(-(F.col("z") + F.lit(shift))))
    return scored.select(F.col("k").alias(key), "origen", F.col("v").alias("valor"), F.round(p, 6).alias("score"), (p >= 0.5).alias("cut"))


def shares(found: DataFrame) -> DataFrame:
    """(origen, n, cut_n, share): how often each source cuts values off."""
    return found.groupBy("origen").agg(F.count("*").alias("n"), F.sum(F.col("cut").cast("long")).alias("cut_n"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("share"))
