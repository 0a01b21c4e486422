"""Spellings of one person linked by merge-and-rematch resolution.

A spelling is parsed into surnames and given names; spellings that agree in them, whatever their case, accents,
titles, order, particles or dates, share a node from the start. Then nodes are matched through blocking keys:

* slips: nodes equal but for one word (or for both surnames, initials apart) that share what is left of that word when
  up to two letters are deleted are one person if the words differ by an edit or two and one is rare;
* shorter forms (a given name or surname left out, initials, nicknames, abbreviations) seek the person whose fuller
  form shortens to them, and are matched only if exactly one person does.

Each merge gives the merged person all spellings, initials and short forms of its parts, and a profile of its fullest
surnames and fullest given names, which may stand together in none of its spellings. The richer persons enter the
blocks again with all these, since what was ambiguous may now be unique and what had no partner may now have one. This
repeats until a round merges nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import product

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbrera.operators.graph import components
from lumbrera.plans.lineage import cut, drop, spread

#: A word is a given name if it stands after the comma so often among all spellings, and mostly there.
GIVEN_LEAST, GIVEN_PART, GIVEN_SHARE = 3, 1e-4, 0.8
#: A word may be a slip if so few nodes have it, or so small a part of those that have the other word.
RARE, RARE_PART = 3, 0.2
#: Forms of one name that are spelled out as keys; beyond them, keys of initials propose and the words are compared.
FORMS = 64
#: Rows of a block up to which its words are compared with each other: fewer pairs a word than it has deletion keys.
SMALL = 32
_TITLE = re.compile(r"(?<![\w.])(?:m\.?\s*en\s+[a-z]\.?|dra?\.?|mtr[oa]\.?|lica?\.?|ing\.?|profa?\.?|arq\.?|biol\.?|psic\.?|ph\.?\s?d\.?)(?=[\s,]|$)")
_PARTICLE = {"de", "del", "la", "las", "los", "y", "e", "da", "do", "dos", "das"}
_DIGIT = str.maketrans("01345789", "oieasTbg".lower())
#: Nicknames and the given names they stand for.
NICKNAMES = {
    "ale": "alejandra alejandro", "beto": "alberto roberto gilberto humberto", "bety": "beatriz", "betty": "beatriz", "chabela": "isabel", "charo": "rosario", "chava": "salvador", "chayo": "rosario",
    "chelo": "consuelo", "chepe": "jose", "chucho": "jesus", "chuy": "jesus", "concha": "concepcion", "conchita": "concepcion", "fer": "fernanda fernando", "fran": "francisco", "gabi": "gabriela gabriel", "gaby": "gabriela", "gollo": "gregorio",
    "goyo": "gregorio", "gus": "gustavo", "javi": "javier", "kike": "enrique", "lalo": "eduardo", "lety": "leticia", "licha": "alicia", "lola": "dolores", "lupe": "guadalupe", "lupita": "guadalupe", "manolo": "manuel", "mague": "margarita",
    "meche": "mercedes", "memo": "guillermo", "nacho": "ignacio", "nando": "fernando", "neto": "ernesto", "paco": "francisco", "pancho": "francisco", "paty": "patricia", "pepe": "jose", "pilo": "porfirio", "polo": "leopoldo", "poncho": "alfonso",
    "quique": "enrique", "rafa": "rafael", "tavo": "gustavo", "tere": "teresa", "tono": "antonio", "toño": "antonio", "vero": "veronica", "vicky": "victoria", "yoli": "yolanda", "nati": "natalia", "caro": "carolina", "dani": "daniela daniel", "lucha": "luz", "luchita": "luz", "chole": "soledad",
}


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().replace("ø", "o").replace("ł", "l").replace("ß", "ss").replace("æ", "ae")) if not unicodedata.combining(c))


def words(text: str) -> list[str]:
    """Words of a plain text without particles; initials keep their point, digits read for letters become letters."""
    out = []
    for t in re.findall(r"[^\W_]+\.?", text):
        core = t.rstrip(".")
        if t in _PARTICLE or core.isdigit() and len(core) > 2:
            continue
        if any(c.isdigit() for c in core) and any(c.isalpha() for c in core):
            core = core.translate(_DIGIT)
        if len(core) == 1 or t.endswith("."):
            out.append(core + ".")
        elif core:
            out.append(core)
    return out


def parse(name: str, given: frozenset[str]) -> tuple[list[str], list[str], str]:
    """(surnames, given names, kind) of a spelling; kind is "person", or "other" for what has no given name."""
    t = _TITLE.sub(" ", plain(name))
    inside = re.search(r"\(([^)]*)\)", t)
    t = re.sub(r"\([^)]*\)?", " ", t)
    head, comma, tail = t.partition(",")
    s, g = words(head), words(tail)
    known = lambda w: w in given or w in NICKNAMES or w.endswith(".")
    if inside and (full := words(inside[1])):
        return (s if comma else [w for w in s if not known(w)]), full, "person"
    if comma:
        if not s or not g:
            return s + g, [], "other"
        while len(g) > 1 and not known(g[0]) and any(w in given for w in g[1:]) and len(s) < 2:
            s, g = [*s, g[0]], g[1:]  # the comma stands after the first surname
        return s, g, "person"
    n = 0
    while n < len(s) and (s[n] in given or s[n] in NICKNAMES or n and s[n].endswith(".")):
        n += 1
    if n and n < len(s):
        return s[n:], s[:n], "person"
    m = len(s)
    while m > 0 and s[m - 1] in given:
        m -= 1
    if 0 < m < len(s):
        return s[:m], s[m:], "person"
    return s, [], "other"


def soft(word: str) -> str:
    """A word without doubled letters: what is typed twice or once compares equal."""
    return re.sub(r"(.)\1+", r"\1", word)


def _h(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def node_key(s: list[str], g: list[str], kind: str) -> int:
    if kind == "other":
        return _h("other", *s)
    return _h("person", *sorted(map(soft, s)), "|", *sorted(map(soft, g)))


def _options(word: str, given: frozenset[str]) -> list[str]:
    """Given names that a short form may stand for; the word itself if it is none."""
    core = word.rstrip(".")
    if word in given or len(core) == 1:
        return [word]
    if core in NICKNAMES:
        return [x for x in NICKNAMES[core].split() if x in given] or [word]
    if word.endswith("."):
        def follows(x: str) -> bool:
            it = iter(x)
            return x[0] == core[0] and all(c in it for c in core)

        return sorted(x for x in given if follows(x)) or [word]
    if len(core) >= 3 and (longer := sorted(x for x in given if x.startswith(core))):
        return longer
    return [word]


def provided(s: list[str], g: list[str]) -> list[int]:
    """Keys of the shorter forms of a full form, and of itself."""
    if not g or any(w.endswith(".") for w in s + g) or not s:
        return []
    s, g = sorted(map(soft, s)), list(map(soft, g))
    out = {_h("I", *s, "|", *sorted(g))}
    mixed = list(product(*[(w, w[0] + ".") for w in g])) if 1 << len(g) <= FORMS else []
    for forms in mixed:
        out.add(_h("B", *s, "|", *sorted(forms)))
    if len(g) > 1:
        out |= {_h("A", *s, "|", w) for w in g} | {_h("A", *s, "|", g[0][0] + ".")}
    first = sorted(w[0] for w in g)
    out.add(_h("L", *s, "|", *first))
    if len(s) == 2:
        for a, b in ((s[0], s[1]), (s[1], s[0])):
            out.add(_h("C", a, "|", *sorted(g)))
            out |= {_h("L", a, "|", *first), _h("L", a, b[0] + ".", "|", *first)}
            for f in mixed or [g]:
                out.add(_h("C", a, b[0] + ".", "|", *sorted(f)))
    return sorted(out)


def sought(s: list[str], g: list[str], given: frozenset[str]) -> list[tuple[str, int]]:
    """(rule, key) under which a shorter form looks for the one fuller form that it may come from. Rule L proposes by
    initials alone: what is found must fit() as well."""
    if not s or not g:
        return []
    options = [_options(w, given) for w in g]
    names = sorted(map(soft, (w for w in s if not w.endswith("."))))
    initials = [w for w in s if w.endswith(".")]
    if len(names) < (1 if len(initials) <= 1 else 2) or initials and len(names) != 1:
        return []
    count = 1
    for o in options:
        count *= len(o)
    short = any(w.endswith(".") for w in g) or any(list(o) != [w] for o, w in zip(options, g))
    if count > FORMS or short and 1 << len(g) > FORMS:
        firsts = product(*[sorted({x[0] for x in o}) for o in options])
        return sorted({("L", _h("L", *names, *initials, "|", *sorted(f))) for f in firsts})
    out = set()
    for c in product(*options):
        c = [w if w.endswith(".") else soft(w) for w in c]
        whole = not any(w.endswith(".") for w in c)
        if len(names) >= 2 and not initials:
            if whole and list(map(soft, g)) != c:
                out.add(("I", _h("I", *names, "|", *sorted(c))))
            if not whole:
                out.add(("B", _h("B", *names, "|", *sorted(c))))
            if len(c) == 1:
                out.add(("A", _h("A", *names, "|", c[0])))
        elif len(names) == 1 and len(initials) == 1:
            out.add(("C", _h("C", names[0], initials[0], "|", *sorted(c))))
        elif len(names) == 1 and not initials and whole and len(c) > 1:
            out.add(("C", _h("C", names[0], "|", *sorted(c))))
    return sorted(out)


def fits(short: list[str], full: list[str], given: frozenset[str]) -> bool:
    """Whether each short given name can stand for another one of the full ones, all of them used."""
    if len(short) != len(full):
        return False
    may = [{i for i, w in enumerate(full) if any(o.endswith(".") and w[0] == o[0] or soft(o) == soft(w) for o in _options(x, given))} for x in short]
    taken: dict[int, int] = {}

    def place(i: int, seen: set[int]) -> bool:
        for j in may[i] - seen:
            seen.add(j)
            if j not in taken or place(taken[j], seen):
                taken[j] = i
                return True
        return False

    return all(place(i, set()) for i in range(len(short)))


def deletions(word: str) -> set[str]:
    """What is left of a word when up to two letters (one, if it has fewer than seven) are deleted."""
    out = front = {word}
    for _ in range(2 if len(word) >= 6 else 1):
        front = {t[:i] + t[i + 1 :] for t in front for i in range(len(t))}
        out = out | front
    return out


def edits(a: str, b: str) -> int:
    """Damerau-Levenshtein distance (optimal alignment), 3 for anything beyond 2."""
    if abs(len(a) - len(b)) > 2:
        return 3
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j - 1] + (x != y), one[j] + 1, row[-1] + 1)
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, one = one, row
        if min(row) > 2:
            return 3
    return min(3, one[-1])


def link_spellings(names: DataFrame, column: str = "name", spent: tuple[DataFrame, ...] = ()) -> DataFrame:
    """(name, person): every distinct non-blank spelling with the id of its person (a number of no further meaning).
    Tables ``spent`` are dropped as soon as ``names`` has been read.

    Null and blank values give no row, repeated rows one. A spelling that matches nothing is a person by itself.
    Values without any given name (institutions, single words) are joined only if they differ in case, accents or
    joining words alone.
    """
    spark = names.sparkSession
    raw = names.select(F.col(f"`{column}`").cast("string").alias("name")).where(F.col("name").rlike(r"\S")).groupBy("name").agg(F.count("*").alias("n"))
    raw = cut(spread(raw), "spellings")
    drop(*spent)
    total = raw.count()

    def roles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        after, before = Counter(), Counter()
        for pdf in batches:
            for x in pdf["name"]:
                head, comma, tail = re.sub(r"\([^)]*\)?", " ", _TITLE.sub(" ", plain(x))).partition(",")
                before.update(words(head) if comma else ())
                after.update(words(tail))
        ws = [w for w in after.keys() | before.keys() if not w.endswith(".") and len(w) > 2]
        yield pd.DataFrame({"w": ws, "a": [after[w] for w in ws], "b": [before[w] for w in ws]}).astype({"w": str, "a": "int64", "b": "int64"})

    least = max(GIVEN_LEAST, total * GIVEN_PART)
    seen = raw.mapInPandas(roles, "w string, a long, b long").groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # Given names make up at most 1 / GIVEN_PART words a position, whatever the number of spellings.
    vocab = frozenset(r["w"] for r in seen.where((F.col("a") >= least) & (F.col("a") >= GIVEN_SHARE * (F.col("a") + F.col("b")))).select("w").collect())
    given = spark.sparkContext.broadcast(vocab)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(x, given.value) for x in pdf["name"]]
            yield pd.DataFrame({"name": pdf["name"], "n": pdf["n"], "node": [node_key(*p) for p in got], "s": [p[0] for p in got], "g": [p[1] for p in got], "kind": [p[2] for p in got]})

    read_names = cut(raw.mapInPandas(read, "name string, n long, node long, s array<string>, g array<string>, kind string"), "parsed")
    nodes = cut(read_names.groupBy("node").agg(F.sum("n").alias("n"), F.min_by(F.struct("s", "g", "kind"), F.struct(-F.col("n"), "name")).alias("p")).select("node", "n", "p.s", "p.g", "p.kind").where("kind = 'person'"), "nodes")
    drop(raw)
    open_words, often = cut(_open_words(nodes), "open-words"), cut(_often(nodes), "surnames")
    labels = cut(nodes.select("node", F.col("node").alias("label")), "labels")
    labels, _ = _merged(labels, _slips(open_words, open_words, often, given))
    keyed = cut(_keys(nodes, given), "keys")
    known = cut(nodes.select("node", "s", "g"), "known")
    while True:
        labels = _rematch(keyed, known, labels, given)
        rich = cut(_profiles(known, labels), "profiles")
        if not rich.limit(1).count():
            break
        # The richer persons enter the blocks again, as nodes that have their label; a profile that another person has
        # as a spelling is that person.
        before = labels, known, keyed
        twins = rich.join(nodes.select("node"), "node").join(labels, "node").select("person", "label").where("person <> label")
        words_ = cut(_open_words(rich.withColumn("n", F.lit(0).cast("long"))), "profile-words")
        of = labels.unionByName(rich.select("node", F.col("person").alias("label")))
        slips = _slips(words_, open_words, often, given).join(of.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(of.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        extra = rich.join(nodes.select("node"), "node", "left_anti")
        labels = cut(labels.unionByName(extra.select("node", F.col("person").alias("label"))), "labels")
        known = cut(known.unionByName(extra.select("node", "s", "g")), "known")
        keyed = cut(keyed.unionByName(_keys(extra, given)), "keys")
        labels, _ = _merged(labels, twins.select(F.col("person").alias("a"), F.col("label").alias("b")).unionByName(slips.select(F.col("la").alias("a"), F.col("lb").alias("b"))))
        drop(*before, rich, words_)
    return read_names.join(labels, "node", "left").select("name", F.coalesce("label", "node").alias("person"))


def _merged(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Labels after links between them, and whether there were any; the labels before are dropped if so."""
    links = cut(links.where("a <> b").distinct(), "merges")
    if not links.limit(1).count():
        return labels, False
    moved = components(links)
    new = cut(labels.join(moved, labels["label"] == moved["id"], "left").select("node", F.coalesce(moved["label"], labels["label"]).alias("label")), "labels")
    drop(links, moved, labels)
    return new, True


def _keys(nodes: DataFrame, given) -> DataFrame:
    """(node, rule, key): rule P for what a full form gives, others for what a shorter one seeks."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for node, s, g in zip(pdf["node"], pdf["s"], pdf["g"], strict=True):
                s, g = list(s), list(g)
                rows += [(node, "P", k) for k in provided(s, g)] + [(node, r, k) for r, k in sought(s, g, given.value)]
            if rows:
                yield pd.DataFrame(rows, columns=["node", "rule", "key"])

    return spread(nodes.select("node", "s", "g")).mapInPandas(keys, "node long, rule string, key long")


def _rematch(keyed: DataFrame, known: DataFrame, labels: DataFrame, given) -> DataFrame:
    """Labels after shorter forms have been matched with the only person that gives their key, until nothing merges."""
    asking, giving = keyed.where("rule <> 'P'"), keyed.where("rule = 'P'").select("node", "key")
    giving = cut(giving.join(asking.select("key").distinct(), "key", "left_semi"), "giving")  # what nobody seeks needn't stay

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [fits(list(a), list(b), given.value) for a, b in zip(pdf["g"], pdf["full"], strict=True)]
            yield pdf[["node", "giver"]][ok]

    long = asking.where("rule = 'L'").select("node", "key").join(known.select("node", "g"), "node").join(giving.select(F.col("node").alias("giver"), "key"), "key")
    long = cut(long.join(known.select(F.col("node").alias("giver"), F.col("g").alias("full")), "giver").select("node", "giver", "g", "full").mapInPandas(fit, "node long, giver long"), "fitting")
    plain_ask = asking.where("rule <> 'L'")
    while True:
        people = giving.join(labels, "node").groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        mine = plain_ask.join(people, "key").groupBy("node", "rule").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        fitted = long.join(labels.withColumnRenamed("node", "giver"), "giver").groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).withColumn("rule", F.lit("L"))
        found = mine.unionByName(fitted).where("lo = hi").join(labels, "node").where("label <> lo").select(F.col("label").alias("a"), F.col("lo").alias("b"))
        labels, moved = _merged(labels, found)
        if not moved:
            drop(giving, long)
            return labels


def _profiles(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, person, s, g): the fullest surnames and given names of each person of several nodes, where they stand
    together in none of its nodes. Maxima are aggregated before rows are exchanged."""
    full = lambda c: F.struct(F.size(F.filter(c, lambda w: ~w.endswith("."))).alias("whole"), F.length(F.array_join(c, "")).alias("long"), F.array_join(F.transform(F.array_sort(c), _soften), " ").alias("soft"), F.col(c).alias("w"))
    of = known.join(labels, "node")
    best = of.groupBy("label").agg(F.max(full("s")).alias("s"), F.max(full("g")).alias("g"), F.count("*").alias("c")).where("c > 1").select(F.col("label").alias("person"), F.col("s.w").alias("s"), F.col("g.w").alias("g"))

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(node=[node_key(list(s), list(g), "person") for s, g in zip(pdf["s"], pdf["g"], strict=True)])[["node", "person", "s", "g"]]

    keyed = best.mapInPandas(key, "node long, person long, s array<string>, g array<string>")
    return keyed.join(of.select("node", F.col("label").alias("person")), ["node", "person"], "left_anti")


def _soften(w: Column) -> Column:
    return F.regexp_replace(w, r"(.)\1+", "$1")


def _open_words(nodes: DataFrame) -> DataFrame:
    """(node, key, side, w): for each word of a name (or both surnames, side ss) the key of all that is beside it."""

    def blanks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for node, s, g in zip(pdf["node"], pdf["s"], pdf["g"], strict=True):
                parts = [("s", soft(w)) for w in s] + [("g", soft(w)) for w in g]
                if len(parts) < 3:
                    continue
                surnames = sorted(soft(w) for w in s)
                if len(surnames) == 2 and min(map(len, surnames)) >= 5:
                    rows.append((node, _h("TT", surnames[0][0], surnames[1][0], *sorted(map(soft, g))), "ss", " ".join(surnames)))
                for i, (side, w) in enumerate(parts):
                    if len(w) >= 4 and not w.endswith("."):
                        others = sorted(f"{a}{b}" for j, (a, b) in enumerate(parts) if j != i)
                        rows.append((node, _h("T", side, *others), side, w))
            if rows:
                yield pd.DataFrame(rows, columns=["node", "key", "side", "w"])

    return spread(nodes).mapInPandas(blanks, "node long, key long, side string, w string")


def _often(nodes: DataFrame) -> DataFrame:
    """(w, c): how many nodes have a surname, which says whether it can be a slip."""
    often = nodes.select(F.explode("s").alias("w")).groupBy("w").agg(F.count("*").alias("c"))
    return often.select(_soften(F.col("w")).alias("w"), "c").groupBy("w").agg(F.sum("c").alias("c"))


def _slips(mine: DataFrame, all_words: DataFrame, often: DataFrame, given) -> DataFrame:
    """Links (a, b) between nodes of ``mine`` and of ``all_words`` that differ in one word (or both surnames) by a slip.
    Words of one block that share what is left of them after deletions are compared, however many the block has; in
    blocks of up to SMALL rows that is looked at pair by pair, so that only words of greater ones are spelled out."""

    def left_over(words_: DataFrame) -> DataFrame:
        def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = [(node, side, w, _h(str(key), d)) for node, key, side, w in zip(pdf["node"], pdf["key"], pdf["side"], pdf["w"], strict=True) for d in deletions(w.split(" ")[0])]
                if rows:
                    yield pd.DataFrame(rows, columns=["node", "side", "w", "d"])

        return words_.mapInPandas(spell, "node long, side string, w string, d long")

    def sharing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [edits(a, b) <= 2 and not deletions(a).isdisjoint(deletions(b)) for a, b in zip(pdf["w"].str.split(" ").str[0], pdf["w2"].str.split(" ").str[0], strict=True)]
            yield pdf[pd.Series(ok, index=pdf.index, dtype=bool)]

    # Only keys that stand for different words of different nodes can have a slip.
    same = mine is all_words
    ends = mine.select("key", "w") if same else mine.select("key", "w").unionByName(all_words.select("key", "w"))
    several = cut(ends.groupBy("key").agg(F.min("w").alias("lo"), F.max("w").alias("hi"), F.count("*").alias("c")).where("lo <> hi").select("key", (F.col("c") <= SMALL).alias("small")), "open-keys")
    small, great = several.where("small").select("key"), several.where("NOT small").select("key")
    second = lambda rows: rows.select(F.col("node").alias("node2"), F.col("w").alias("w2"), rows.columns[-1])
    order = "w < w2" if same else "w <> w2"
    pairs = mine.join(small, "key", "left_semi").join(second(all_words.select("node", "w", "key")), "key").where(order)
    # Two edits are four at most where swapped letters count as two.
    first = lambda c: F.substring_index(c, " ", 1)
    pairs = pairs.where(F.levenshtein(first("w"), first("w2"), 4) >= 0).select("node", "node2", "side", "w", "w2")
    kind = "node long, node2 long, side string, w string, w2 string"
    near = cut(left_over(mine.join(great, "key", "left_semi")), "near-words")
    other = near if same else cut(left_over(all_words.join(great, "key", "left_semi").join(mine.select("key").distinct(), "key", "left_semi")), "other-words")
    # Divided before columns are renamed, both sides of a join with itself are one exchange.
    met = near.repartition("d").join(second(other.repartition("d")), "d").where(order).select("node", "node2", "side", "w", "w2")
    met = pairs.mapInPandas(sharing, kind).unionByName(met).distinct()
    part = lambda c, i: F.element_at(F.split(c, " "), i)

    def counted(rows: DataFrame, w: str, c: str) -> DataFrame:
        """The nodes that have the word, or the commoner one of both surnames."""
        for i, n in ((1, "x"), (-1, "y")):
            rows = rows.join(often.select(F.col("w").alias(n), F.col("c").alias(f"c{n}")), part(w, i) == F.col(n), "left").drop(n)
        return rows.withColumn(c, F.greatest(F.coalesce("cx", F.lit(0)), F.coalesce("cy", F.lit(0)))).drop("cx", "cy")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = [], []
            for x in pdf.itertuples():
                if x.side == "ss":
                    (a1, b1), (a2, b2) = x.w.split(" "), x.w2.split(" ")
                    if 0 < edits(a1, a2) <= 2 and 0 < edits(b1, b2) <= 2 and min(x.c, x.c2) <= RARE:
                        a.append(x.node)
                        b.append(x.node2)
                    continue
                d = edits(x.w, x.w2)
                if d == 0 or d > 2 or d == 2 and min(len(x.w), len(x.w2)) < 7:
                    continue
                if x.side == "g":
                    ok = not (x.w in given.value and x.w2 in given.value) and d == 1
                else:
                    lo, hi = sorted((x.c, x.c2))
                    ok = lo <= RARE or lo <= RARE_PART * hi
                if ok:
                    a.append(x.node)
                    b.append(x.node2)
            yield pd.DataFrame({"a": a, "b": b}).astype("int64")

    met = cut(met, "met-words")
    drop(near, several, *([] if same else [other]))
    slips = cut(counted(counted(met, "w", "c"), "w2", "c2").mapInPandas(judge, "a long, b long"), "slips")
    drop(met)
    return slips
