import json
import os

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__
from logloom.plans import queries
from logloom.sources import framed, logs, tables

DATA = "/root/testdata/sf0.001"


def lines(a, b):
    return "".join(json.dumps({"session_id": "s", "seq": i, "type": "t"}) + "\n" for i in range(a, b)).encode()


def test_framed_logs(spark, tmp_path):
    whole = logs.compress_batch(lines(0, 3)) + logs.compress_batch(lines(3, 50))
    torn = len(logs.compress_batch(lines(0, 3))) + 60
    for name, data in (("a", whole), ("b", whole[:torn])):
        (tmp_path / f"{name}.zst").write_bytes(data)
    assert logs.scan_frames(whole[:torn])[1] == torn - 60 and logs.scan_frames(whole, 1)[0] == [lines(0, 3)]
    with pytest.raises(logs.BrokenLog):
        logs.scan_frames(b"junk" + whole)
    got = logs.read_framed_log(spark, str(tmp_path / "a.zst"))
    assert got.count() == 50 and got.filter("seq = 49").count() == 1
    assert logs.read_framed_log(spark, str(tmp_path / "b.zst")).count() >= 3


def test_json_logs(spark, tmp_path):
    log = spark.createDataFrame([("s", 1, "b"), ("s", 0, "a")], "session_id string, seq long, type string")
    logs.write_log(log, str(tmp_path / "log"))
    got = logs.read_log(spark, str(tmp_path / "log"))
    assert [r["type"] for r in logs.partial_read(got, "s", 1, 5).collect()] == ["b"]


def test_keyed_tables(spark, tmp_path):
    folder = str(tmp_path / "kv")
    row = lambda *r: spark.createDataFrame([r], "key string, value string, version long")
    for change in (row("a", "1", 1), row("b", "1", 1), row("a", "2", 2)):
        tables.put(spark, folder, change)
    tables.delete(spark, folder, row("b", None, 3))
    assert [tuple(r) for r in tables.load(spark, folder).collect()] == [("a", "2", 2)]
    os.makedirs(tmp_path / "docs")
    for name, content in (("x", '{"version":3,"key":"k","value":"v"}'), ("y", "not json"), ("z", '{"version":9,"key":"q"}')):
        (tmp_path / "docs" / name).write_text(content)
    assert [r["key"] for r in tables.load_documents(spark, str(tmp_path / "docs"), [3]).collect()] == ["k"]


def test_dataset_and_blobs(spark, tmp_path):
    root = str(tmp_path / "set")
    tasks = spark.createDataFrame([("t", "FAILED", None, 1, 1), ("t", "SUCCESS", None, 2, 2), ("u", "ERROR", "infrastructure", 1, 1)], "task_id string, status string, error_class string, finished_at long, attempts int")
    tables.write_tasks(tasks, root)
    assert {(r["task_id"], r["bucket"]) for r in tables.read_tasks(spark, root).collect()} == {("t", "success"), ("u", "invalid_infrastructure-error")}
    tables.write_tasks(tasks.filter("task_id = 't'").withColumn("status", F.lit("TIMEOUT")), root)
    assert {(r["task_id"], r["bucket"]) for r in tables.read_tasks(spark, root).collect()} == {("t", "failed"), ("u", "invalid_infrastructure-error")}
    blobs = spark.createDataFrame([(b"x",), (b"x",), (b"yy",)], "content binary")
    keys = tables.put_blobs(blobs, root)
    assert sorted(r["bytes"] for r in keys.collect()) == [1, 2]
    assert [bytes(r["content"]) for r in tables.get_blobs(spark, root, keys.filter("bytes = 2")).collect()] == [b"yy"]
    entry = spark.createDataFrame([("t", "SUCCESS", 1)], "task_id string, status string, attempts int")
    tables.append_index(entry, root)
    assert tables.read_index(spark, root).select("task_id").first()[0] == "t"
    (tmp_path / "set" / "index" / "more.json").write_text('\n  \n{"task_id":"u"}\n')
    assert {r["task_id"] for r in tables.read_index(spark, root).collect()} == {"t", "u"}
    (tmp_path / "set" / "index" / "bad.json").write_text('{"task_id":\n')
    with pytest.raises(Exception):
        tables.read_index(spark, root).collect()


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_queries_without_sql_give_rows(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_surface_of_conversations_keeps_every_event(spark):
    rows = spark.read.parquet(f"{DATA}/conversations.parquet").count()
    folded = queries.QUERIES["surface_state"](spark, DATA)
    assert folded.count() == rows and folded.filter(F.col("surface") == "shadowed").count() > 0


def test_framed_source_splits_files(spark, tmp_path):
    rows = [(f"s{i % 3}", i // 3, "user/message", f"text {i} é" * 20) for i in range(600)]
    log = spark.createDataFrame(rows, "session_id string, seq long, type string, data string")
    folder = str(tmp_path / "framed")
    framed.write_log(log, folder, frame_rows=10)
    assert sorted(p.name for p in (tmp_path / "framed").iterdir()) == [f"s{i}.jsonl.zst" for i in range(3)]
    for size in (400, 1 << 30):
        found = framed.read_events(spark, folder, partition_bytes=size)
        assert sorted((r["session_id"], r["seq"], r["type"], r["data"]) for r in found.collect()) == sorted(rows)
    lines = framed.read_lines(spark, folder, partition_bytes=700)
    assert lines.filter("session = 's1'").select(F.spark_partition_id().alias("p")).distinct().count() > 3
    assert lines.filter("session = 's1'").count() == 200 and lines.count() == 600
    some = framed.read_lines(spark, folder, ["s0", "s2"], partition_bytes=700)
    assert some.filter("place = 0").count() == 40 and some.rdd.getNumPartitions() < lines.rdd.getNumPartitions()
    assert framed.read_lines(spark, folder, ["none"]).count() == 0
    heads = framed.read_lines(spark, folder, header_only=True)
    assert heads.count() == 30 and heads.agg(F.max("frame")).first()[0] == 0
    whole = (tmp_path / "framed" / "s0.jsonl.zst").read_bytes()
    (tmp_path / "torn").mkdir()
    for name, data in (("torn", whole[:-9]), ("empty", b""), ("short", whole + b"\x28\xb5")):
        (tmp_path / "torn" / f"{name}.jsonl.zst").write_bytes(data)
    torn = framed.read_lines(spark, str(tmp_path / "torn"), partition_bytes=900).groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.max("torn").alias("torn")).collect()
    assert {r["session"]: (r["n"] >= 190, r["torn"]) for r in torn}["short"] == (True, False)
    assert {r["session"] for r in torn} <= {"torn", "short"}
    (tmp_path / "bad.jsonl.zst").write_bytes(whole + b"junk that is no frame")
    with pytest.raises(Exception, match="no frame at byte"):
        framed.read_lines(spark, str(tmp_path / "bad.jsonl.zst")).count()
    with pytest.raises(Exception, match="can't be a file's"):
        framed.write_log(log.withColumn("session_id", F.lit("a/b")), str(tmp_path / "refused"))


@pytest.mark.parametrize("sizes", [(True, True), (False, True), (True, False)])
def test_frame_ends_from_headers(sizes, tmp_path):
    data = b"".join(zstandard.ZstdCompressor(write_content_size=sizes[0], write_checksum=sizes[1]).compress(part) for part in (b"a" * 10, bytes(range(256)) * 3000, b"x" * 500_000, b""))
    (tmp_path / "f").write_bytes(data)
    ends = []
    with pa.OSFile(str(tmp_path / "f")) as file:
        at = 0
        while at < len(data):
            at = framed.frame_end(file, at, len(data))
            ends.append(at)
        assert len(ends) == 4 and ends[-1] == len(data)
        for cut in (1, 5, 8, ends[0] - 1):
            assert framed.frame_end(file, 0, cut) is None
