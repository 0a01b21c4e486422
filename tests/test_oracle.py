"""Every query with SQL gives the rows that DuckDB gives; every query runs."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

from lumbrera.queries import catalogue, runnable

ENTRIES = catalogue()


def plain(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(data):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if sql])
def test_same_rows(spark, data, duck, name):
    df = runnable(ENTRIES)[name](spark, data)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    result = duck.execute(ENTRIES[name][1])
    cols = [d[0] for d in result.description]
    want = sorted((tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in result.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if not sql])
def test_runs(spark, data, name):
    df = runnable(ENTRIES)[name](spark, data)
    assert df.columns and df.count() > 0


def test_queries_without_sql_agree_with_those_that_have_it(spark, data):
    run = runnable(ENTRIES)
    rows = lambda name: run[name](spark, data).collect()
    assert sorted(map(tuple, rows("cov_profile_whole"))) == sorted(map(tuple, rows("cov_profile")))
    assert all(r["whole"] for r in rows("postings_codec"))
    top = {(r["source"], r["term"]) for r in rows("ctfidf_top8")}
    assert {(r["source"], t) for r in rows("topic_labels") for t in r["label"].split(" · ")} == top
    exact = {(r["src"], r["dst"]) for r in rows("knn_exact")}
    found = {(r["src"], r["dst"]) for r in rows("knn_inverted_lists")}
    assert len(exact & found) / len(exact) >= 0.9
    whole, place, advisors = {r["src"]: r for r in rows("context_document")}, rows("context_analysis_each"), rows("context_advisors")
    assert set(whole) == {r["src"] for r in place}
    for r in place:
        w = whole[r["src"]]
        assert (w["neighbours"], w["lectura"], w["cluster"]) == (r["neighbours"], r["lectura"], r["cluster"]) and (w["ubicacion"] or [{"cluster": None}])[0]["cluster"] == r["cluster"]
        assert [a["asesor"] for a in w["asesores"]] == [a["asesor"] for a in sorted(advisors, key=lambda a: a["rank"]) if a["src"] == r["src"]]
        assert len(w["cercanas"]) == min(15, r["neighbours"]) and len(w["saturacion"]) == 8 and len(w["palabras"]) == 5


def test_queue_query_against_a_plain_replay(spark, data):
    from lumbrera.streaming.events import Queue

    log = []
    for r in spark.read.parquet(f"{data}/events.parquet").selectExpr("event_type", "event_id", "unix_timestamp(cast(ts as timestamp)) AS t").collect():
        log += [(float(r["t"]), r["event_id"], "arrive", r["event_type"]), (r["t"] + 900.0, r["event_id"], "finish", r["event_type"])]
    queues: dict = {}
    for t, job, kind, k in sorted(log, key=lambda x: x[:2]):
        q = queues.setdefault(k, Queue(seats=2, lease=1200.0))
        (q.arrive if kind == "arrive" else q.finish)(job, t)
    want = {(k, job, t) for k, q in queues.items() for job, t in q.started}
    assert {(r["k"], r["job"], r["started"]) for r in runnable(ENTRIES)["queue_fifo"](spark, data).collect()} == want
