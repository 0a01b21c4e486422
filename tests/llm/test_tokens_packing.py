from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbrera.llm import packing as P
from lumbrera.llm import tokens as K

encode = K.encoder()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t's,re.aáñ1 　​—l漢🙂", max_size=80), st.integers(1, 9))
def test_tree_equals_whole(text, leaf):
    assert K.encode_tree(text, encode, leaf=leaf) == encode(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200), st.integers(1, 20))
def test_any_text_any_cut(text, leaf):
    text = text.encode("utf-8", "ignore").decode()
    assert K.encode_tree(text, encode, leaf=leaf) == encode(text)
    assert K.decode(K.encode_tree(text, encode, leaf=leaf)) == text


def test_joining_is_associative():
    random.seed(1)
    for _ in range(200):
        parts = ["".join(random.choice(" ab's\n.1") for _ in range(random.randint(0, 12))) for _ in range(3)]
        a, b, c = ((p, encode(p)) for p in parts)
        assert K.join(K.join(a, b, encode), c, encode) == K.join(a, K.join(b, c, encode), encode) == ("".join(parts), encode("".join(parts)))


def test_corpus(spark):
    long = "El agua de la sierra no llega. " * 400
    rows = [(1, None), (2, ""), (3, "   "), (4, "hola <|endoftext|> aquí"), (5, long), (6, "x" * 5000), (4, "repetida")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    got = K.encode_corpus(df, piece=700)
    assert got.columns == ["doc_id", "ids"]
    have = sorted((r["doc_id"], list(r["ids"])) for r in got.collect())
    assert have == sorted((i, encode(t or "")) for i, t in rows)
    assert K.encode_corpus(df.where("doc_id < 0")).count() == 0


def check(rows, capacity):
    used: dict = {}
    for r in rows:
        if r["container"] is None:
            assert r["n_tokens"] == 0
        else:
            used.setdefault(r["container"], []).append((r["start"], r["length"], r["slot"]))
    for parts in used.values():
        parts.sort()
        at = 0
        for k, (start, length, slot) in enumerate(parts):
            assert start == at and slot == k
            at += length
        assert at <= capacity
    assert sorted(used) == list(range(len(used)))
    return len(used)


def first_fit(sizes, capacity):
    rooms: list[int] = []
    for n in sorted(sizes, reverse=True):
        k = next((k for k, room in enumerate(rooms) if room >= n), None)
        if k is None:
            rooms.append(capacity - n)
        else:
            rooms[k] -= n
    return len(rooms)


def test_packing(spark):
    random.seed(2)
    sizes = [random.choice([1, 7, 30, 30, 30, 55, 99, 100]) for _ in range(500)] + [100, 250, 0, 0, 301]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)] + [(900, None)], "doc_id long, n int")
    rows = P.pack(df, "n", ["doc_id"], capacity=100, rounds=60).collect()
    bins = check(rows, 100)
    assert bins <= first_fit([n % 100 for n in sizes if n % 100] + [100] * sum(n // 100 for n in sizes), 100)
    by: dict = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r["length"])
    assert all(sum(by[i]) == n for i, n in enumerate(sizes)) and all(len(by[i]) == 1 for i, n in enumerate(sizes) if n <= 100)
    assert sorted(by[501], reverse=True) == [100, 100, 50] and by[900] == [0]
    assert P.pack(df.where("n < 0"), "n", ["doc_id"]).count() == 0
    assert P.pack(df.where("n = 0 OR n IS NULL"), "n", ["doc_id"]).where("container IS NULL").count() == 3


def test_equal_rows_each_get_a_place(spark):
    df = spark.createDataFrame([(1, 40)] * 5, "doc_id long, n int")
    assert check(P.pack(df, "n", ["doc_id"], capacity=100, salts=3).collect(), 100) == 3


@pytest.mark.parametrize("hist", [{1: 5}, {100: 3}, {60: 4, 40: 4}, {34: 9, 33: 9}])
def test_plan_is_tight(hist):
    plan = P.plan(hist, 100, 60)
    assert sum(t for t, _ in plan.configs) <= plan.bound + 2
    for times, content in plan.configs:
        assert times > 0 and sum(k * a for k, a in content.items()) <= 100


def test_knapsack_price_is_best():
    import itertools

    import numpy as np

    lengths, counts = np.array([3, 5, 7]), np.array([9.0, 9.0, 9.0])
    values = np.array([0.31, 0.52, 0.74])
    best = max(sum(v * a for v, a in zip(values, c)) for c in itertools.product(range(8), repeat=3) if sum(x * a for x, a in zip(lengths, c)) <= 20)
    got = P.price(values, lengths, counts, 20)
    assert sum(values[k] * a for k, a in got.items()) == pytest.approx(best)


def test_corpus_matches_other_library(spark, data):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{K.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r["doc_id"]: list(r["ids"]) for r in K.encode_corpus(docs.where(F.col("text").isNotNull())).collect()}
    for r in docs.where("text IS NOT NULL").select("doc_id", "text").collect():
        assert got[r["doc_id"]] == t.encode(r["text"], add_special_tokens=False).ids


def test_the_program_wins_and_its_dual_bounds_it():
    rng = np.random.default_rng(3)
    sizes = np.concatenate([rng.integers(20, 300, 4000), rng.integers(700, 1400, 900)])
    p = P.plan({int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True))}, 2048)
    assert p.by == "program" and sizes.sum() / 2048 <= p.bound <= p.containers <= 1.01 * p.bound + 1
    thirds = P.plan({700: 90}, 2048)  # two in a container, whatever the volume says
    assert thirds.containers == 45 and thirds.bound == 45
