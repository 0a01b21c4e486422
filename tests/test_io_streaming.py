from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from lumbrera.sources import readers as S
from lumbrera.sources import writers as K
from lumbrera.streaming import events as R


def test_pages():
    html = "<table><tr><td>100 1# - Autor</td><td>Robles, Ana</td></tr><tr><td>y otra</td></tr><tr><th>245 10 - Título</th><td>El agua &amp; el riego</td></tr></table>"
    assert S.parse_marc(html) == [("100", "1#", "Autor", ["Robles, Ana", "y otra"]), ("245", "10", "Título", ["El agua & el riego"])]
    assert S.parse_marc(None) == [] and S.parse_results("") == []
    page = '<a href="/x?biblionumber=12">El agua</a> 1999 Autor: Robles | <a href="/x?biblionumber=13">El riego</a> s/f'
    assert [(r[0], r[1], r[2]) for r in S.parse_results(page)] == [("12", "El agua", "1999"), ("13", "El riego", "")]
    assert S.parse_detail('<a href="a.pdf?doc_number=7">x</a> 2001')[:3] == ("7", "a.pdf?doc_number=7", "2001")
    assert S.stop_after([["a"], [], [], [], ["b"]], 99) == 4 and S.stop_after([["a"]] * 9, 99) == 4 and S.stop_after([["a"], ["b"]], 0) == 1


def test_npy_blob_schema(spark, tmp_path):
    x = np.arange(40, dtype=np.float32).reshape(10, 4)
    np.save(tmp_path / "m.npy", x)
    rows = S.npy(spark, str(tmp_path / "m.npy"), rows=3).orderBy("row").collect()
    assert [r["v"] for r in rows] == x.tolist()
    man = K.packed_manifest(3, {"a": "int32", "b": "float32"})
    content = np.array([1, 2, 3], "<i4").tobytes() + np.array([0.5, 1, 2], "<f4").tobytes()
    assert S.blob(content, man)["b"].tolist() == [0.5, 1.0, 2.0]
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string", "maxLength": 2}, "b": {"type": "array", "items": {"type": "integer"}}}, "additionalProperties": False}
    assert S.schema_errors({"a": "xyz", "b": [1, "x"], "c": 1}, schema) == ["$.a: too large", "$.b[1]: not integer", "$.c: unknown"]
    assert S.schema_errors({}, schema) == ["$.a: missing"]


def test_requests(spark):
    df = spark.createDataFrame([(json.dumps({"title": "El agua"}),), ("{",), (json.dumps({"title": "x"}),), (None,)], "body string")
    assert [len(r["errors"]) for r in S.requests(df, "body").collect()] == [0, 1, 1, 1]


def test_sinks(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("shard"), F.lit("x").alias("v"))
    p = str(tmp_path / "t")
    K.append_shards(df.where("shard < 2"), p, "shard")
    assert K.missing_shards(df, p, "shard").count() == 3
    K.append_shards(df, p, "shard")
    assert spark.read.parquet(p).count() == 10
    K.documents(df, str(tmp_path / "d"), "shard", [-F.col("id")])
    docs = spark.read.json(str(tmp_path / "d"))
    assert docs.count() == 3
    audit = K.versioned(df.withColumn("v", F.when(F.col("id") < 4, "y").otherwise(F.col("v"))).select("id", "v"), df.select("id", "v"), str(tmp_path / "v2"), "v", "r1").collect()
    assert [tuple(a) for a in audit] == [("x", "y", 4, "r1")]
    assert K.packed(df, [F.col("id")], {"id": "int64"}, 4).agg(F.sum("count")).collect()[0][0] == 10
    K.report(df, str(tmp_path / "r"))
    assert S.csv_text(spark, str(tmp_path / "r")).count() == 10
    K.append_lines(df, str(tmp_path / "j"))
    assert S.json_lines(spark, str(tmp_path / "j"), "id long, v string", without=["v"]).columns == ["id"]
    assert K.sse(df.limit(1), F.lit("datos"), F.struct("id")).collect()[0]["frame"].startswith("event: datos\ndata: {")


def run(stream, mode, name, spark):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams_agree_with_batch(spark, data, tmp_path):
    batch = spark.read.parquet(f"{data}/events.parquet")
    batch.write.parquet(str(tmp_path / "ev"))
    src = R.source(spark, str(tmp_path / "ev"))
    # Windows that the watermark has closed come out; they agree with the batch.
    got = {(r["start"], r["event_type"]): r["n"] for r in run(R.tumbling(src, "1 day", "0 seconds"), "append", "w1", spark).collect()}
    want = {(r["start"], r["event_type"]): r["n"] for r in R.tumbling(batch, "1 day").collect()}
    assert got and all(want[k] == n for k, n in got.items())
    assert run(R.once(src.select("event_type", "ts"), ["event_type"], "365 days"), "append", "w2", spark).count() == batch.select("event_type").distinct().count()


def test_stream_quotas(spark, data, tmp_path):
    batch = spark.read.parquet(f"{data}/events.parquet").select("event_id", "user_id", "ts")
    batch.write.parquet(str(tmp_path / "q"))
    got = {r["event_id"]: r["admitted"] for r in run(R.stream_quotas(R.source(spark, str(tmp_path / "q")), 300, 20, 2), "append", "q1", spark).collect()}
    want = {r["event_id"]: r["admitted"] for r in R.all_quotas(batch, "user_id", 300, 20, 2).collect()}
    assert got == want


def test_latest_is_idempotent(spark, tmp_path):
    write = R.upsert_latest(str(tmp_path / "l"), "k", "seq")
    a = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, seq int, s string")
    b = spark.createDataFrame([("a", 2, "z"), (None, 3, "n")], "k string, seq int, s string")
    for batch, i in ((a, 0), (b, 1), (b, 1)):
        write(batch, i)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "l/v=1")).select("k", "s").collect()) == [("a", "z"), ("b", "y")]
