from __future__ import annotations

import pytest

from lumbrera.llm import canon as C
from lumbrera.llm import garbled as G
from lumbrera.llm import people as P
from lumbrera.llm import quality as Q
from lumbrera.llm import truncated as T

SURNAMES = ["Solares", "Mireda", "Peñalba", "Ruidíaz", "Cárdena", "Oñate", "Zubiría", "Ibáñez", "Güemes", "Larrúa", "Bermón", "Cadalso", "Escobal", "Fuerzán"]
GIVEN = ["Ana", "Luz", "José", "Inés", "Ramón", "Sofía", "Andrés", "Begoña"]
NAMES = [f"{a} {b}, {g} {h}" for i, a in enumerate(SURNAMES) for b in SURNAMES[i + 1 :] for g, h in ((GIVEN[(i * 3 + len(b)) % 8], GIVEN[(i + len(b) + 4) % 8]),)]


def read_as(text, written, read):
    return text.encode(written).decode(read)


GARBLES = [
    read_as("Peñalba Ruidíaz, José", "utf-8", "latin-1"), read_as("Peñalba Ruidíaz, José", "utf-8", "cp437"), read_as("Peñalba Ruidíaz, José", "utf-8", "mac_roman"),
    read_as("Peñalba Ruidíaz, José", "cp1252", "cp437"), read_as("Peñalba Ruidíaz, José", "cp1252", "cp1251"), read_as(read_as("Peñalba Ruidíaz, José", "utf-8", "latin-1"), "utf-8", "cp1252"),
]


def test_garbled(spark):
    clean = [*NAMES, "Dvořák, Jiřina", "Groß-Hübner, Käthe", "MAGALHÃES, ÂNGELO", "¿Quién? (?)", None, "", "x" * 20000 + "é"]
    lost = ["Pe�alba Ruid�az, Jos�", "Pe?alba Ruid?az, Jos?"]
    rows = [(f"c{i}", v) for i, v in enumerate(clean)] + [(f"g{i}", v) for i, v in enumerate(GARBLES + lost)] + [("g0", GARBLES[0]), ("m", f"{GARBLES[0]} | Ibáñez Güemes, Inés")]
    df = spark.createDataFrame([(k, v, "clash", "clash") for k, v in rows], "id string, f string, v string, k string")
    got: dict = {}
    for r in G.find_garbled(df, ["f"], "id").collect():
        got.setdefault(r["id"], []).append(r["restaurado"])
    assert {k for k in got if k[0] == "c"} <= {f"c{len(NAMES) + 3}"} and {f"g{i}" for i in range(len(GARBLES) + 2)} <= set(got)
    assert [got[f"g{i}"][0] for i in range(len(GARBLES))] == ["Peñalba Ruidíaz, José"] * len(GARBLES) and len(got["g0"]) == 2
    assert got["m"] == ["Peñalba Ruidíaz, José | Ibáñez Güemes, Inés"]
    assert G.find_garbled(df.where("id = 'none'"), ["f"], "id").count() == 0


def test_lost_letters_come_back_where_one_value_fits(spark):
    df = spark.createDataFrame([("a", "Peñalba Ruidíaz, José"), ("b", "Pe?alba Ruid?az, Jos?"), ("c", "Or?, Luz")], "id string, f string")
    got = {r["id"]: r["restaurado"] for r in G.find_garbled(df, ["f"], "id").collect()}
    assert got == {"b": "Peñalba Ruidíaz, José", "c": None}


def test_dictionaries_count_the_words_of_all_clean_values(spark, monkeypatch):
    clean = spark.range(6000).selectExpr("concat('Peñalba Ñ', id, 'x') AS v")
    words = " ".join(G.digests(clean)["es"]).split()
    assert words.count("Peñalba") == 6000 and len(set(words)) == 6001
    monkeypatch.setattr(G, "DIGEST", 100)
    assert " ".join(G.digests(clean)["es"]).split() == ["Peñalba"] * 50  # half of all words


def test_no_word_is_left_out_of_the_dictionaries(spark, monkeypatch):
    seen, whole = [], G.digests
    monkeypatch.setattr(G, "DIGEST", 100)
    monkeypatch.setattr(G, "digests", lambda *a, **k: seen.append(whole(*a, **k)) or seen[-1])
    df = spark.range(600).selectExpr("id", "concat('Peñalba Ñ', repeat('a', cast(id % 7 as int)), char(97 + id % 26), char(97 + id div 26)) AS f")
    G.find_garbled(df, ["f"], "id").count()
    words = " ".join(seen[0]["es"]).split()
    assert len(set(words)) == 601 and words.count("Peñalba") == 50  # rare words once, common ones by their share


def test_every_letter_beyond_ascii_competes():
    coder = G.Coder({"es": [*NAMES, "VILLÀ SOLARES, ANA", "ELCHÀ PEÑALBA, JOSÉ", *(f"Pérez {x}, Luz" for x in SURNAMES)] * 3, "pt": ["Magalhães, Ângelo", "Gonçalves, João"]})
    for text in ("VILLÀ SOLARES, ANA", "Pérez Solares, Luz"):
        for written, read in (("utf-8", "latin-1"), ("cp1252", "cp850")):
            if written == "utf-8" or text[0] == "P":
                assert G.restore(read_as(text, written, read), coder)[0] == text, (text, written)
    assert [G.restore(x, coder)[2] for x in ("Peñalba Ruidíaz, José", "Magalhães, Ângelo", "Sol?res, Ana", "??igo Solares, Ana", "? | ?")] == [False, False, True, True, False]


def test_people(spark):
    same = ["Solares Peñalba, Ana Luz", "SOLARES PENALBA, ANA LUZ", "Ana Luz Solares Peñalba", "Solares, Peñalba Ana Luz", "Dra. Solares Peñalba, Ana Luz", "Solares Peñalba, A. L.", "Solares Peñalba, Ana Luz, 1950", "Solares de Peñalba, Ana Luz", "Solares-Peñalba, Ana Luz", "Peñalba Solares, Ana Luz", "Solares P., Ana Luz", "Solares Peñalva, Ana Luz", "S0lares Peñalba, Ana Luz", "Solares Peñalba, A. L. (Ana Luz)"]
    other = ["Solares Peñalba, Ramón Andrés", "Solares Mireda, Inés Luz", "Taller de Oficios y Memoria"]
    noise = [n for n in NAMES if "Solares" not in n or "Peñalba" not in n]
    names = same + other + noise + noise[:5] + [None, "", "  "]
    df = spark.createDataFrame([(n, "c", 1) for n in names], "name string, person string, node int")
    got = {r["name"]: r["person"] for r in P.link_spellings(df).collect()}
    assert {got[n] for n in same} == {got[same[0]]}
    assert len({got[n] for n in [same[0], *other]}) == 4 and len(got) == len(set(names) - {None, "", "  "})
    assert P.link_spellings(df.where("name = 'none'")).count() == 0


@pytest.mark.parametrize(("text", "s", "g"), [("M. en C. Robles Pérez, Ana", ["robles", "perez"], ["ana"]), ("Robles, Ana L.", ["robles"], ["ana", "l."]), ("ana luz robles perez", ["robles", "perez"], ["ana", "luz"]), ("Robles, Pérez Ana", ["robles", "perez"], ["ana"]), ("E. Y. Robles", ["e.", "y.", "robles"], [])])
def test_parse_names(text, s, g):
    assert P.parse(text, frozenset({"ana", "luz"}))[:2] == (s, g)


def catalogue(spark):
    rows = [(1, "facultad de hidrologia uav", "Facultad de hidrología", "FHI"), (2, "facultad de historia oral uav", "Facultad de historia oral", "FHO"), (3, "instituto de suelos uav", "Instituto de suelos", "ISU"), (4, None, None, None)]
    return spark.createDataFrame(rows, "plantel_id int, plantel_canonico string, plantel_display string, sigla string")


@pytest.mark.parametrize("limit", [2_000_000, 60])
def test_canonical(spark, limit):
    entries = {"facultad de hidrologia uav": 1, "Facultad de Hidrología, UAV": 1, "facutlad de hidrologia": 1, "fac. de hidrologia uav": 1, "hidrologia facultad": 1, "FHI": 1, "facultad dde hidrologia": 1, "FHO UAV": 2, "inst. de sue1os uav": 3, "universidad autonoma de valdesierra instituto de suelos": 3, "facultad de hidrologia universidad de otra parte": 0, "N/A": 0, "...": 0, "x" * 3000: 0}
    df = spark.createDataFrame([(k, k, "c") for k in entries] + [("n", None, "c"), ("e", "", "c"), ("FHI", "FHI", "c")], "id string, v string, k string")
    rows = C.map_entries(df, "id", "v", catalogue(spark), "plantel_id", ["plantel_canonico", "plantel_display", "sigla"], broadcast_keys=limit).collect()
    assert {r["id"]: r["plantel_id"] for r in rows} == entries and len(rows) == len(entries) + 1
    assert C.map_entries(df.where("id = 'none'"), "id", "v", catalogue(spark), "plantel_id", ["plantel_canonico"]).count() == 0
    assert {r["plantel_id"] for r in C.map_entries(df, "id", "v", catalogue(spark).where("plantel_id > 9"), "plantel_id", ["plantel_canonico"]).collect()} == {0}


def test_distance_and_deletes():
    assert C.distance("abc", "acb", 3) == 0.8 and C.distance("abc", "abbc", 3) == pytest.approx(0.7) and C.distance("abcd", "wxyz", 2) == float("inf")
    assert "ac" in C.deletes("abc", 1) and "" not in C.deletes("abc", 2)


def test_truncated_held_out(spark):
    import random

    random.seed(4)
    full = [random.choice(NAMES) + (f" | {random.choice(NAMES)}" if random.random() < 0.4 else "") for _ in range(1500)]
    rows, cut = [], set()
    for i, v in enumerate(full):
        o = ("a", "b", None)[i % 3]
        w = v
        if o == "b" and len(v) > 36:
            w = v[:36].rstrip()
        elif random.random() < 0.05:
            w = v[: random.randint(8, len(v) - 3)].rstrip()
        if w != v:
            cut.add(f"T{i}")
        rows.append((f"T{i}", w, o, "clash"))
    rows += [("N", None, "a", ""), ("E", "", "b", ""), ("B", "   ", "a", ""), ("T0", rows[0][1], "a", "")]
    df = spark.createDataFrame(rows, "id string, f string, origen string, v string")
    got = T.find_truncated(df, "id", "f", "origen").collect()
    assert {r["id"] for r in got} == {f"T{i}" for i in range(1500)}
    found = {r["id"] for r in got if r["cut"]}
    assert len(found & cut) / len(cut) > 0.85 and len(found & cut) / len(found) > 0.85
    share = {r["origen"]: r for r in T.shares(T.find_truncated(df, "id", "f", "origen")).collect()}
    assert share["b"]["share"] > share["a"]["share"] and set(share) == {"a", "b", ""}
    assert T.find_truncated(df.where("id = 'none'"), "id", "f", "origen").count() == 0
    assert not T.find_truncated(df.limit(3), "id", "f", "origen").where("cut").count()


PROSE = "Los vecinos dijeron que el canal se rompe cada invierno y que nadie lo repara. En la segunda visita se midió el agua de los pozos. "


def test_quality(spark):
    docs = {
        **{i: PROSE * (1 + i % 4) for i in range(200)}, 300: PROSE.upper() * 2, 301: PROSE.replace(".", "").lower() * 2, 302: PROSE.replace(" que", "\nque").replace(" y", "\ny"),
        400: "\n".join(f"- Conocer el canal {w}" for w in ("alto", "bajo", "viejo", "nuevo")), 401: ", ".join(["canal", "pozo", "acequia", "presa", "noria", "molino"] * 4), 402: PROSE * 3 + "\n- uno\n- dos\n- tres",
        500: "\n".join("\t".join(str(a * b) for a in range(1, 5)) for b in range(3, 12)), 501: "\n".join(f"| {a} | s/d | {a * 7} |" for a in range(9)), 502: PROSE * 3 + "\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |",
        600: "canal " * 80, 601: "xq3#~ ^&}{ <>|\\ `@#$ %^&* " * 6, 602: "wqrtzx plkmnb vcxzqw rtpsdf ghjklz xcvbnm " * 4, 700: None, 701: "", 702: " \n\t ",
    }
    df = spark.createDataFrame([(k, v, "c", 1) for k, v in docs.items()], "doc_id long, text string, clase string, k int")
    got = {r["doc_id"]: r for r in Q.classify(df, rounds=8).collect()}
    assert len(got) == len(docs)
    assert {got[i]["clase"] for i in [*range(200), 300, 301, 302, 402, 502]} == {"prosa"}
    assert {got[i]["clase"] for i in (400, 401)} == {"lista"} and {got[i]["clase"] for i in (500, 501)} == {"tabla"} and {got[i]["clase"] for i in (600, 601, 602)} == {"basura"}
    assert {got[i]["clase"] for i in (700, 701, 702)} == {None} and got[700]["palabras"] == 0
    assert Q.classify(df.where("doc_id < 0")).count() == 0


def test_document_statistics():
    assert Q.document_statistics("El agua sube.\nBaja") == (4, 3.5, 0.0667, 0.5, 0.25)
    assert Q.document_statistics(None) == (0, 0.0, 0.0, 0.0, 0.0)


def test_slips_in_a_full_block_and_richer_persons(spark):
    given = [f"{a}{b}ela" for a in "bcdfglmnprst" for b in ("an", "or", "il", "us")]  # given names of one block
    block = [f"Quirante Oldaz, {g.title()} Luz" for g in given for _ in (0, 1, 2)]
    typo = "Quirante Oldaz, Banlea Luz"  # sorted order puts others between it and its twin
    long = ["Villa Marte, Ana Luz José Inés Ramón Sofía Andrés", "Villa Marte, A. L. J. I. R. S. A."]
    rich = ["Arcadio P., Ana Luz", "Arcadio Penalte, A. L.", "Arcadio Penalte, Ana Luz Inés"]
    names = [*NAMES * 3, *block, typo, *long, *rich, *(f"{x}, {g.title()} Inés" for g in given for x in ("Otero Salim", "Marte Calvo", "Rueda Ponte"))]
    got = {r["name"]: r["person"] for r in P.link_spellings(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got[typo] == got["Quirante Oldaz, Banela Luz"] and len({got[n] for n in block}) == len(given)
    assert got[long[0]] == got[long[1]]
    assert got[rich[0]] != got[rich[2]]


def test_fits():
    given = frozenset({"jose", "ana", "luz", "luis"})
    assert P.fits(["l.", "ana"], ["ana", "luz"], given) and P.fits(["pepe"], ["jose"], given)
    assert not P.fits(["l.", "luz"], ["ana", "luz"], given) and not P.fits(["l."], ["ana", "luz"], given)
    assert "acd" in P.deletions("abcd") and "abce" in P.deletions("abcdef") | P.deletions("abced") and len(P.deletions("abc")) == 4


def test_slips_of_small_blocks_are_compared_without_keys(spark, monkeypatch):
    from lumbrera.llm import people

    kept, cut = {}, people.cut

    def counted(df, label):
        out = cut(df, label)
        kept.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(people, "cut", counted)
    surnames = ["Villaseca Montoro", "Carbajal Quirarte", "Zepeda Olmedilla", "Arizmendi Trejo"]
    names = [f"{s}, {g}" for s in surnames for g in ("Marcela Inés", "Rodrigo Saúl", "Tomás Elías")]
    slips = {"Villasecca Montoro, Marcela Inés": 0, "Vilaseka Montoro, Rodrigo Saúl": 1, "Carbajla Quirarte, Marcela Inés": 3, "Zepeda Olmeddila, Tomás Elías": 8, "Arizmenid Trejjo, Rodrigo Saúl": 10}
    df = spark.createDataFrame([(n,) for n in [*names, *slips]], "name string")
    groups = {}
    for most in (32, 0):  # by pairs alone, and by deletion keys alone
        kept.clear()
        monkeypatch.setattr(people, "SMALL", most, raising=False)
        of = {r["name"]: r["person"] for r in people.link_spellings(df).collect()}
        groups[most] = sorted(sorted(n for n in of if of[n] == p) for p in {*of.values()})
        assert all(of[x] == of[names[i]] for x, i in slips.items()) and len({*of.values()}) == len(names)
        assert (sum(kept["near-words"]) == 0) == (most > 0), most
    assert groups[32] == groups[0]
