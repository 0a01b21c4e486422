from __future__ import annotations

from pyspark.sql import functions as F

from lumbrera.operators.packed import cautious, dialects, parse, shape, split_packed

PEOPLE = [f"Sol{a}nes Mir{b}eda, Ana {c}" for a in "abcd" for b in "efg" for c in ("Luz", "Eva")]


def frame(spark, texts):
    return spark.createDataFrame([(f"T{i}", t, "clash", "clash") for i, t in enumerate(texts)], "id string, f string, v string, value string")


def split(spark, texts):
    rows = split_packed(frame(spark, PEOPLE + texts), ["f"], "id").collect()
    out: dict = {}
    for r in sorted(rows, key=lambda r: r["posicion"]):
        out.setdefault(r["id"], []).append(r["valor"])
    return [out.get(f"T{len(PEOPLE) + i}") for i in range(len(texts))]


def test_delimiters_quotes_marks(spark):
    a, b, c = PEOPLE[0], PEOPLE[5], PEOPLE[9]
    texts = [f"{a} | {b}", f"{a};{b}", f"{a} // {b}", f"{a} / {b}", f"{a} & {b}", f"{a} y {b}", f"{a}\t{b}", f"{a}\n{b}", f"1. {a} 2. {b}", f"(1) {a} (2) {b}", f'"{a}","{b}"', f'["{a}", "{b}"]', f"|| {a} ;; {b}", f'"{a}"; "{b}"']
    assert split(spark, texts) == [[a, b]] * len(texts)
    assert split(spark, [f"{a} | {b} y {c}", f'{a} | "Taller A | B"', f'"{a}"', a, f"{a} |"]) == [[a, b, c], [a, "Taller A | B"], [a], [a], [a]]


def test_joining_word_inside_a_surname(spark):
    name = "Robles y Miranda, Ana Luz"
    assert split(spark, [name, f"{name} | {PEOPLE[1]}", f"{PEOPLE[2]} | {name}"]) == [[name], [name, PEOPLE[1]], [PEOPLE[2], name]]


def test_edges(spark):
    long = " | ".join(PEOPLE * 40)
    got = split(spark, [None, "", "   ", "|;|", long, '""'])
    assert got[:4] == [None] * 4 and got[4] == PEOPLE * 40
    assert split_packed(frame(spark, []), ["f"], "id").count() == 0
    twice = frame(spark, [f"{PEOPLE[0]} | {PEOPLE[1]}"])
    assert split_packed(twice.unionAll(twice), ["f"], "id").count() == 4
    out = split_packed(frame(spark, PEOPLE), ["f", "v"], "id")
    assert out.columns == ["id", "campo", "posicion", "valor", "n"] and out.where(F.col("campo") == "v").count() == len(PEOPLE)


def test_parse_functions():
    assert shape("Sola Mira, Ana L. de 12") == "WW,Wipn"
    assert cautious("A | B y C") == ["A", "B y C"]
    assert parse('"a ""b"" c"; d', ("semicolon",), True, False) == ['a "b" c', "d"]
    assert {n for n, _, _ in dialects("A & B / C")} >= {"whole", "ampersand", "slash", "slash+ampersand"}
