"""Advisors resolved by sequential rules, each precise rather than complete.

Mentions become variants, (surnames, given names) after normalisation. Each rule proposes links through an equi-join
or a group on a block key; a link is kept only where one target fits. Rules run one after the other, each seeing the
groups that the ones before have made, and every rule's outcome depends on keys and counts alone, not on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumbrera.functions import text as X
from lumbrera.operators.edits import deletion_keys, meeting
from lumbrera.operators.graph import relabel
from lumbrera.operators.relational import ids_over, keep_first
from lumbrera.plans.lineage import cut, settled

#: Titles, particles.
_TITLE = r"\b(m en [a-z]|dra?|mtr[oa]|lic|ing|profa?|arq|phd)\b"
PARTICLES = ("de", "del", "la", "las", "los", "y")


def _words(c: Column) -> Column:
    k = F.regexp_replace(X.key(X.replace_all(c, X.REPAIRS)), _TITLE, " ")
    return F.filter(F.split(F.trim(k), r"\s+"), lambda w: (w != "") & ~w.rlike(r"^\d{4}$"))


def mentions(df: DataFrame, key: str, names: Column, program: Column) -> DataFrame:
    """(key, orden, name, program): one row a name of a list, with its place."""
    return df.select(F.col(key), program.alias("program"), F.posexplode(X.clean_list(names)).alias("orden", "name")).select(key, (F.col("orden") + 1).alias("orden"), "name", "program")


def variants(m: DataFrame) -> DataFrame:
    """(node, ap, no, bag, comma, n, programs, display): distinct normalised forms. Forms of one word are left out."""
    parts = m.select("name", "program", _words(F.substring_index("name", ",", 1)).alias("ap"), _words(F.regexp_extract("name", r"^[^,]*,(.*)$", 1)).alias("no"), F.col("name").contains(",").alias("comma"))
    parts = parts.where(F.size("ap") + F.size("no") > 1)
    node = F.xxhash64(F.array_join("ap", " "), F.array_join("no", " "))
    by_name = parts.withColumn("node", node).groupBy("node", "ap", "no", "comma", "name").agg(F.count("*").alias("n"), F.collect_set("program").alias("programs"))
    g = by_name.groupBy("node").agg(F.first("ap").alias("ap"), F.first("no").alias("no"), F.bool_or("comma").alias("comma"), F.sum("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("programs"))).alias("programs"), F.min_by("name", F.struct(-F.col("n"), "name")).alias("display"))
    return g.withColumn("bag", F.array_join(F.array_sort(F.concat("ap", "no")), " "))


def _only(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, target): groups all of whose rows have one label."""
    return rows.groupBy(*keys).agg(F.min("label").alias("target"), F.max("label").alias("_hi")).where("target = _hi").drop("_hi")


def _links(seekers: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    return seekers.join(targets, keys).where("label <> target").select(F.col("label").alias("a"), F.col("target").alias("b"))


def _joined(c: str) -> Column:
    return F.array_join(c, " ")


def _bare(c: str) -> Column:
    return F.array_join(F.array_sort(F.filter(c, lambda w: ~w.isin(*PARTICLES))), " ")


def _initials(c: str) -> Column:
    return F.array_join(F.transform(c, lambda w: F.substring(w, 1, 1)), "")


def same_bag(v: DataFrame) -> DataFrame:
    """R2: a form without a comma and the only form with one that has the same words; and a form of at most two mentions
    whose words stand on the other side of the comma in the only form that is five times as frequent, in a shared program."""
    bare = _links(v.where("NOT comma").select("bag", "label"), _only(v.where("comma"), ["bag"]), ["bag"])
    turned = v.where("comma").select("bag", "node", "label", "n", "programs", _joined("ap").alias("s"), _joined("no").alias("g"))
    to = turned.select("bag", F.col("label").alias("target"), F.col("n").alias("tn"), F.col("programs").alias("tp"), F.col("s").alias("ts"), F.col("g").alias("tg"))
    found = turned.where("n <= 2").join(to, "bag").where((F.col("s") == F.col("tg")) & (F.col("g") == F.col("ts")) & (F.col("tn") >= 5 * F.col("n")) & F.arrays_overlap("programs", "tp"))
    return bare.unionByName(_sole(found))


def _compatible() -> Column:
    """Whether the given names ``no`` are, in order, words of ``lno`` or their initials."""
    word = lambda w: F.concat(F.lit("\\Q"), w, F.when(F.length(w) == 1, F.lit("\\E\\S*")).otherwise(F.lit("\\E")))
    pattern = F.concat(F.lit("^(?:\\S+ )*"), F.array_join(F.transform("no", word), " (?:\\S+ )*"), F.lit("(?: \\S+)*$"))
    return F.rlike(_joined("lno"), pattern)


def _sole(found: DataFrame) -> DataFrame:
    """Links of the candidates (node, label, target) of forms all of whose candidates have one label."""
    only = found.groupBy("node").agg(F.first("label").alias("a"), F.min("target").alias("b"), F.max("target").alias("_hi"))
    return only.where("b = _hi AND a <> b").select("a", "b")


def shorter_given(v: DataFrame) -> DataFrame:
    """R3: the same surnames, two or more, and given names that are, in order, some of those of one longer form or their
    initials; a single given name needs a shared program. Longer forms that have a longer one themselves don't count."""
    v = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).withColumn("s", _joined("ap"))
    initial = lambda w: F.substring(w, 1, 1)
    long = v.where(F.size("no") > 1).select("s", F.explode(F.array_distinct(F.concat("no", F.transform("no", initial)))).alias("k"), F.col("node").alias("to"), F.col("no").alias("lno"), F.col("label").alias("target"), F.col("programs").alias("tp"))
    pairs = v.withColumn("k", F.get("no", F.lit(0))).join(long, ["s", "k"]).where((F.size("lno") > F.size("no")) & _compatible())
    pairs = cut(pairs.select("node", "label", "to", "target", ((F.size("no") > 1) | F.arrays_overlap("programs", "tp")).alias("fits")).distinct(), "shorter")
    top = pairs.join(pairs.select(F.col("node").alias("to")).distinct(), "to", "left_anti")
    return _sole(top.withColumn("all", F.min("fits").over(Window.partitionBy("node"))).where("all"))


def initials(v: DataFrame) -> DataFrame:
    """R3: the same surnames, two or more, and as many given names, some of them told by their initials, as one form."""
    v = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).withColumn("s", _joined("ap")).withColumn("i", _initials("no"))
    long = v.select("s", "i", F.col("node").alias("to"), F.col("no").alias("lno"), F.col("label").alias("target"))
    short = v.where(F.exists("no", lambda w: F.length(w) == 1))
    return _sole(short.join(long, ["s", "i"]).where((F.col("no") != F.col("lno")) & _compatible()))


def one_surname(v: DataFrame) -> DataFrame:
    """R4: one surname and the same given names as the only form that has it first of two, in a shared program."""
    one = v.where((F.size("ap") == 1) & (F.size("no") > 0)).select(F.get("ap", F.lit(0)).alias("s"), _joined("no").alias("g"), "label", F.explode("programs").alias("p"))
    two = v.where((F.size("ap") == 2) & (F.size("no") > 0)).select(F.get("ap", F.lit(0)).alias("s"), _joined("no").alias("g"), "label", F.explode("programs").alias("p"))
    return _links(one, _only(two, ["s", "g", "p"]), ["s", "g", "p"]).distinct()


def reordered(v: DataFrame) -> DataFrame:
    """R6: the same surnames without particles and the same given names in another order."""
    k = v.where((F.size("ap") >= 2) & (F.size("no") >= 2)).select(_bare("ap").alias("s"), _bare("no").alias("g"), "label")
    return _links(k, k.groupBy("s", "g").agg(F.min("label").alias("target")), ["s", "g"])


def _given() -> Column:
    return F.array_sort(F.array_distinct(F.filter("no", lambda w: ~w.isin(*PARTICLES))))


def fewer_given(v: DataFrame) -> DataFrame:
    """R6: the same surnames without particles, and given names, in any order, that are some of those of forms of one
    group only. Four equal words or more, or else a shared program."""
    k = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).select("node", "label", "programs", F.size("ap").alias("words"), _bare("ap").alias("s"), _given().alias("gs")).where(F.size("gs") > 0)
    long = k.where(F.size("gs") > 1).select("s", F.explode("gs").alias("k"), F.col("gs").alias("lgs"), F.col("label").alias("target"), F.col("programs").alias("tp"))
    met = k.withColumn("k", F.get("gs", F.lit(0))).join(long, ["s", "k"]).where((F.size("lgs") > F.size("gs")) & (F.size(F.array_except("gs", "lgs")) == 0))
    fits = F.arrays_overlap("programs", "tp") | (F.col("words") + F.size("gs") >= 4)
    return _sole(met.withColumn("all", F.min(fits).over(Window.partitionBy("node"))).where("all"))


def misplaced_comma(v: DataFrame) -> DataFrame:
    """R8: the same words with the comma elsewhere, where that is no inversion of two forms of equal build."""
    k = v.where("comma").withColumn("build", F.size("ap"))
    top = k.groupBy("bag").agg(F.max_by(F.struct("label", "build"), F.struct("n", F.col("label"))).alias("t")).select("bag", F.col("t.label").alias("target"), F.col("t.build").alias("tb"))
    return k.join(top, "bag").where("label <> target AND build <> tb").select(F.col("label").alias("a"), F.col("target").alias("b"))


def _groups(v: DataFrame) -> DataFrame:
    """(label, gn, gp): mentions and programs of the groups so far."""
    return v.groupBy("label").agg(F.sum("n").alias("gn"), F.array_distinct(F.flatten(F.collect_list("programs"))).alias("gp"))


def _by_group(found: DataFrame, groups: DataFrame, ratio: int) -> DataFrame:
    """Links of groups (label) all of whose candidates (target), ``ratio`` times as frequent and with a shared program,
    are one group."""
    t = groups.select(F.col("label").alias("target"), F.col("gn").alias("tn"), F.col("gp").alias("tp"))
    fit = found.where("label <> target").select("label", "target").distinct().join(groups, "label").join(t, "target").where((F.col("tn") >= ratio * F.col("gn")) & F.arrays_overlap("gp", "tp"))
    return _sole(fit.withColumn("node", F.col("label")))


def inverted(v: DataFrame) -> DataFrame:
    """R9: surnames in the other order, each within an edit, against the only group that is at least ten times as frequent."""
    k = v.where((F.size("ap") == 2) & (F.size("no") > 0)).select("label", _joined("no").alias("g"), F.get("ap", F.lit(0)).alias("s1"), F.get("ap", F.lit(1)).alias("s2"))
    to = k.select(F.explode(deletion_keys("g", "s2")).alias("key"), F.col("g").alias("tg"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("label").alias("target"))
    near = k.withColumn("key", F.explode(deletion_keys("g", "s1"))).join(to.hint("merge"), "key").where(F.col("g") == F.col("tg")).where((F.levenshtein("s1", "t2") <= 1) & (F.levenshtein("s2", "t1") <= 1))
    return _by_group(near, _groups(v), 10)


def typos(v: DataFrame, ratio: int = 3) -> DataFrame:
    """R5: a form of at most two mentions and the only group with a form at least ``ratio`` times as frequent, in a shared
    program, whose given names (with equal surnames) or surnames (with equal given names and first letter) are within
    two edits, or one below eight letters. Candidates come from deletion keys, whatever the size of a block."""
    k = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).select("node", "label", "n", "programs", _joined("ap").alias("s"), _joined("no").alias("g"))
    side = lambda same, w: F.struct(same.alias("same"), F.col(w).alias("w"))
    sides = k.select("node", "n", F.explode(F.array(side(F.concat_ws("|", F.lit("s"), "s"), "g"), side(F.concat_ws("|", F.lit("g"), F.substring("s", 1, 1), "g"), "s"))).alias("e"))
    met = meeting(sides, "node", "e.same", "e.w", seeks="n <= 2", owns=f"n >= {ratio}").toDF("node", "to")
    to = k.select(F.col("node").alias("to"), F.col("n").alias("tn"), F.col("s").alias("ts"), F.col("g").alias("tg"), F.col("programs").alias("tp"), F.col("label").alias("target"))
    near = lambda w, tw: F.levenshtein(w, tw) <= F.when(F.length(w) >= 8, 2).otherwise(1)
    given = (F.col("s") == F.col("ts")) & near("g", "tg")
    surnames = (F.col("g") == F.col("tg")) & (F.substring("s", 1, 1) == F.substring("ts", 1, 1)) & near("s", "ts")
    return _sole(met.join(k, "node").join(to, "to").where((F.col("tn") >= ratio * F.col("n")) & (given | surnames) & F.arrays_overlap("programs", "tp")))


def whole_typos(v: DataFrame, ratio: int = 3, common: int = 20) -> DataFrame:
    """R10: whole names within two edits (one below fourteen letters), first letters as well, with a surname and the
    given name's initial in common, against the only group at least ``ratio`` times as frequent in a shared program.
    Names of three words or fewer that differ only in words that are both common are other persons."""
    k = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).select("node", "label", F.concat("ap", "no").alias("ws"), F.slice("ap", 1, 2).alias("s"), F.substring(F.get("no", F.lit(0)), 1, 1).alias("i")).withColumn("w", _joined("ws"))
    met = meeting(k, "node", "i", "w").toDF("node", "to")
    to = k.select(F.col("node").alias("to"), F.col("i").alias("ti"), F.col("w").alias("tw"), F.col("ws").alias("tws"), F.col("s").alias("ts"), F.col("label").alias("target"))
    p = met.join(k, "node").join(to, "to").where((F.col("label") != F.col("target")) & (F.col("i") == F.col("ti")) & F.arrays_overlap("s", "ts"))
    p = cut(p.where(F.levenshtein("w", "tw") <= F.when(F.length("w") >= 14, 2).otherwise(1)).select("label", "target", "ws", "tws").distinct(), "whole-typos")
    usual = v.select(F.explode(F.concat("ap", "no")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("f")).where(F.col("f") >= common).select("word")
    short = (F.size("ws") == F.size("tws")) & (F.size("ws") <= 3)
    differ = p.where(short).select("label", "target", "ws", "tws", F.explode(F.filter(F.arrays_zip("ws", "tws"), lambda x: x["ws"] != x["tws"])).alias("d"))
    rare = differ.join(usual.select(F.col("word").alias("x"), F.lit(1).alias("fx")), F.col("d.ws") == F.col("x"), "left").join(usual.select(F.col("word").alias("y"), F.lit(1).alias("fy")), F.col("d.tws") == F.col("y"), "left").where("fx IS NULL OR fy IS NULL")
    return _by_group(p.where(~short).select("label", "target").unionByName(rare.select("label", "target")), _groups(v), ratio)


def same_sound(v: DataFrame) -> DataFrame:
    """R11: two surnames or more and twelve letters or more that sound the same."""
    k = v.where((F.size("ap") >= 2) & (F.size("no") > 0)).select(X.phonetic(F.concat_ws(" ", _joined("ap"), _joined("no"))).alias("f"), "label", "n").where(F.length("f") >= 12)
    return _links(k, k.groupBy("f").agg(F.max_by("label", F.struct("n", F.col("label"))).alias("target")), ["f"])


RULES = (("R2", same_bag), ("R3i", initials), ("R3", shorter_given), ("R4", one_surname), ("R5", typos), ("R6", reordered), ("R6s", fewer_given), ("R8", misplaced_comma), ("R9", inverted), ("R10", whole_typos), ("R11", same_sound))


def resolve(m: DataFrame) -> DataFrame:
    """(node, label, ap, no, n, display, programs, regla): variants with the group they belong to and the rule that first
    merged them (R1 for those that stand alone)."""
    v = cut(variants(m), "variants")
    labels = cut(v.select("node", F.col("node").alias("label")), "labels")
    rule = cut(v.select("node", F.lit("R1").alias("regla")), "rules")
    for name, f in RULES:
        links = cut(f(v.join(labels, "node")).distinct(), f"links-{name}")
        if not links.limit(1).count():
            continue
        new = relabel(labels, links)
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").select("node", F.lit(name).alias("r"))
        rule = cut(rule.join(changed, "node", "left").select("node", F.when((F.col("regla") == "R1") & F.col("r").isNotNull(), F.col("r")).otherwise(F.col("regla")).alias("regla")), "rules")
        labels = new
    return v.join(labels, "node").join(rule, "node").select("node", "label", "ap", "no", "n", "display", "programs", "regla")


def catalogue(groups: DataFrame) -> DataFrame:
    """(asesor_id, nombre, n_tesis, n_variantes): persons numbered by number of theses; the name shown is the one with
    most words, then most mentions, then accents, among the variants with a fifth of the most frequent one's."""
    top = groups.groupBy("label").agg(F.max("n").alias("m"), F.sum("n").alias("n_tesis"), F.count("*").alias("n_variantes"))
    good = groups.join(top, "label").where(F.col("n") >= 0.2 * F.col("m"))
    accents = F.length("display") - F.length(F.regexp_replace("display", "[áéíóúüñÁÉÍÓÚÜÑ]", ""))
    best = keep_first(good, ["label"], F.desc(F.size("ap") + F.size("no")), F.desc("n"), F.desc(accents), F.col("display"))
    named = best.select("label", F.col("display").alias("nombre"), "n_tesis", "n_variantes")
    return ids_over(named, [F.desc("n_tesis"), F.col("nombre"), F.col("label")], "%d").withColumn("asesor_id", F.col("new_id").cast("long")).drop("new_id")


#: Given names of three letters or fewer, which are no residues.
SHORT_NAMES = ("ma", "jose", "ana", "eva", "luz", "pia", "ali", "rey", "ian", "leo", "noe", "ada", "ivo", "ely", "ciro")
_ODD = r"[ÃÂ�?\d@#*_]"


def suspicious(groups: DataFrame, residues: int = 40) -> DataFrame:
    """(tipo, a, b, comparten): what resolution may have missed, by the names shown of two persons, and whether they share
    a program.

    A the same given names in another order, B some of them in another order, C the same words divided otherwise, D
    surnames inverted, E surnames within two edits, F given names within two edits, G equal but for particles; H short
    words that are frequent among given names (a report of the ``residues`` commonest; b is their number), I names with
    odd characters (b is null). Where a type makes classes (A, C, D, G), each person of a class is paired with its first
    one, so that the pairs span the class without being all of it; the others are found by deletion keys, in blocks of
    any size."""
    f = groups.where((F.size("ap") > 0) & (F.size("no") > 0)).select("label", "ap", "no", _joined("ap").alias("s"), _joined("no").alias("g"), F.array_join(F.array_sort("no"), " ").alias("sg"), F.array_distinct("no").alias("gs"), _bare("ap").alias("bare"), F.array_join(F.array_sort(F.concat("ap", "no")), " ").alias("bag"))
    f = cut(f, "forms")

    def classes(*keys: str) -> DataFrame:
        first = f.groupBy(*keys).agg(F.min_by(F.struct(F.col("label").alias("a"), F.col("ap").alias("ap1"), F.col("s").alias("s1")), F.struct("label", "s")).alias("x"), F.max("label").alias("hi")).where("x.a <> hi").select(*keys, "x.*")
        return f.join(first, list(keys)).where("label <> a").withColumn("b", F.col("label"))

    def near(same: str, word: str, least: int) -> DataFrame:
        k = f.where(F.length(word) >= least).select("label", F.col(same).alias("same"), F.col(word).alias("w")).distinct()
        k = cut(k.withColumn("i", F.monotonically_increasing_id()), "words")
        to = k.select(F.col("i").alias("j"), F.col("same").alias("tsame"), F.col("w").alias("tw"), F.col("label").alias("b"))
        met = meeting(k, "i", "same", "w").toDF("i", "j").where("i < j")
        return met.join(k, "i").join(to, "j").where((F.col("label") != F.col("b")) & (F.col("same") == F.col("tsame")) & (F.levenshtein("w", "tw") <= 2)).select(F.col("label").alias("a"), "b", "w", "tw")

    typed = lambda rows, tipo: rows.select(tipo.alias("tipo"), "a", "b")
    inverted_ = (F.size("ap") == 2) & (F.reverse("ap") == F.col("ap1"))
    long = f.where(F.size("gs") > 1).select("s", F.explode("gs").alias("k"), F.col("no").alias("lno"), F.col("gs").alias("lgs"), F.col("label").alias("b"))
    some = f.withColumn("k", F.array_min("gs")).join(long.hint("merge"), ["s", "k"]).where((F.col("label") != F.col("b")) & (F.size("lgs") > F.size("gs")) & (F.size(F.array_except("gs", "lgs")) == 0) & ~_compatible())
    kinds = [
        lambda: typed(classes("s", "sg"), F.lit("A")), lambda: typed(some.withColumn("a", F.col("label")), F.lit("B")), lambda: typed(classes("bag"), F.when(inverted_, "D").otherwise("C")),
        lambda: typed(classes("bare", "g").where("s <> s1"), F.lit("G")), lambda: typed(near("g", "s", 8), F.lit("E")), lambda: typed(near("s", "g", 6).where(F.array_sort(F.split("w", " ")) != F.array_sort(F.split("tw", " "))), F.lit("F")),
    ]
    pairs = None
    for rows in kinds:  # one after the other: the driver never holds the plan and the stages of all of them at once
        found = settled(lambda rows=rows: rows().select("tipo", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")
        pairs = found if pairs is None else pairs.unionByName(found)
    person = cut(groups.groupBy("label").agg(F.max_by("display", F.struct("n", "display")).alias("shown"), F.array_distinct(F.flatten(F.collect_list("programs"))).alias("p")), "persons")
    of = lambda c: person.select(F.col("label").alias(c), F.col("shown").alias(f"{c}_shown"), F.col("p").alias(f"{c}_p"))
    named = pairs.join(of("a"), "a").join(of("b"), "b").select("tipo", F.col("a_shown").alias("a"), F.col("b_shown").alias("b"), F.coalesce(F.arrays_overlap("a_p", "b_p"), F.lit(False)).alias("comparten"))
    words = groups.select(F.explode("no").alias("w")).where((F.length("w") <= 3) & ~F.col("w").isin(*PARTICLES, *SHORT_NAMES)).groupBy("w").agg(F.count("*").alias("c")).where("c >= 5").orderBy(F.desc("c"), "w").limit(residues)
    odd = groups.where(F.col("display").rlike(_ODD)).select(F.lit("I").alias("tipo"), F.col("display").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(False).alias("comparten")).distinct()
    return named.unionByName(words.select(F.lit("H").alias("tipo"), F.col("w").alias("a"), F.col("c").cast("string").alias("b"), F.lit(False).alias("comparten"))).unionByName(odd)
