import base64
import json

import pytest
from pyspark.sql import functions as F

from ratingloom.plans.catalog import streams
from ratingloom.sources import files
from ratingloom.sources.changes import decode_changes
from ratingloom.sources.keyed_state import KeyedState
from ratingloom.sources.snapshot import compact_snapshot, read_snapshot, upsert_latest
from ratingloom.streaming import drift, history


def test_jdbc_options():
    options = files.jdbc_options("jdbc:x", "public.reviews", "me", "secret", partition_column="id", lower=0, upper=9, partitions=4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4" and options["dbtable"] == "public.reviews"
    assert "partitionColumn" not in files.jdbc_options("jdbc:x", "t")


def test_empty_source(spark):
    with pytest.raises(files.EmptySource):
        files.require_rows(spark.range(0), "t")
    assert files.require_rows(spark.range(1), "t").count() == 1


def test_jsonl(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b"],), (["c"],)], "items array<string>")
    files.write_sequences(df, str(tmp_path / "s"))
    lines = sorted(l for p in (tmp_path / "s").glob("part-*") for l in p.read_text().splitlines())
    assert lines == ['["a","b"]', '["c"]']
    assert sorted(r["items"] for r in files.read_sequences(spark, str(tmp_path / "s")).collect()) == [["a", "b"], ["c"]]
    files.write_recommendations(spark.createDataFrame([("x", ["y"], [0.5])], "target_item string, rec_item_ids array<string>, rec_scores array<double>"), str(tmp_path / "r"))
    assert files.read_recommendations(spark, str(tmp_path / "r")).first()["rec_item_ids"] == ["y"]


def record(user, item, time, rating=1.0):
    body = json.dumps({"data": {"user_id": user, "item_id": item, "rating": rating, "timestamp": time}})
    return base64.b64encode(body.encode()).decode()


def test_decode(spark):
    plain = json.dumps({"data": {"user_id": "u", "item_id": "i", "rating": 2, "timestamp": "t"}})
    rows = [(record("u", "i", "t"),), ("%%%",), (base64.b64encode(b"{broken").decode(),), (None,), (base64.b64encode(b'{"x": 1}').decode(),)]
    good, bad = decode_changes(spark.createDataFrame(rows, "payload string"))
    assert [tuple(r) for r in good.collect()] == [("u", "i", 1.0, "t")]
    assert bad.count() == 4
    good, bad = decode_changes(spark.createDataFrame([(plain,)], "payload string"), base64=False)
    assert good.first()["rating"] == 2.0 and bad.isEmpty()


def test_snapshot_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "snap")
    first = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (1, 12, "c")], "k long, t long, v string")
    late = spark.createDataFrame([(1, 11, "late"), (3, 1, "d")], "k long, t long, v string")
    for number, df in ((0, first), (1, late), (1, late), (0, first)):
        upsert_latest(df, number, path, ["k"], ["t"])
    expected = {1: "c", 2: "b", 3: "d"}
    assert {r["k"]: r["v"] for r in read_snapshot(spark, path, ["k"], ["t"]).collect()} == expected
    compact_snapshot(spark, path, str(tmp_path / "compact"), ["k"], ["t"])
    assert {r["k"]: r["v"] for r in read_snapshot(spark, str(tmp_path / "compact"), ["k"], ["t"]).collect()} == expected


def test_history_stream_and_restart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    snapshot, checkpoint = str(tmp_path / "snap"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.schema("payload string").json(str(source))
        history.start_history(stream, snapshot, checkpoint).awaitTermination()
        return {r["user_id"]: r for r in history.current_users(spark, snapshot).collect()}

    def put(name, payloads):
        (source / name).write_text("\n".join(json.dumps({"payload": p}) for p in payloads))

    day = "2024-01-{:02d}T00:00:00.000Z"
    put("1.json", [record("a", f"i{d}", day.format(d)) for d in range(12, 0, -1)] + ["junk", record("b", "x", "not a time")])
    users = run()
    assert users["a"]["recent_items"] == ",".join(f"i{d}" for d in range(3, 13))
    assert users["a"]["n_events"] == 12 and users["a"]["item_sequence_ts_bucket"][-1] == 0
    assert users["b"]["item_sequence_ts"] == [-1] * 10 and users["b"]["item_sequence_ts_bucket"] == [-1] * 10
    assert run()["a"] == users["a"]  # nothing new
    put("2.json", [record("a", "late", day.format(1)), record("a", "new", day.format(20))])
    again = run()
    assert again["a"]["recent_items"].split(",")[-2:] == ["late", "new"] and again["a"]["n_events"] == 14
    assert again["b"]["recent_items"] == "x"


def test_records_of_a_batch_are_decoded_once(spark, tmp_path, monkeypatch):
    """Each step of an update decoded the whole batch again."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text("\n".join(json.dumps({"payload": record("a", f"i{n}", "2024-01-01T00:00:00.000Z")}) for n in range(5)))
    plans = []

    def update(self, batch, number, advance, keep=KeyedState.update):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return keep(self, batch, number, advance)

    monkeypatch.setattr(KeyedState, "update", update)
    stream = spark.readStream.schema("payload string").json(str(source))
    history.start_history(stream, str(tmp_path / "snap"), str(tmp_path / "cp")).awaitTermination()
    assert len(plans) == 1 and "payload" not in plans[0]
    assert history.current_users(spark, str(tmp_path / "snap")).first()["n_events"] == 5


def test_a_large_slice_of_records_has_several_files(spark, tmp_path, monkeypatch):
    """One task decoded up to a million records."""
    monkeypatch.setattr(streams, "RECORDS_PER_FILE", 10, raising=False)
    rows = spark.range(200).selectExpr("id AS event_id", "id % 7 AS user_id", "'x' AS event_type", "1.0D AS value",
        "'{\"k\": 5}' AS props", "CAST(timestamp_seconds(1700000000 + id) AS timestamp_ntz) AS ts")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    asked = []
    monkeypatch.setattr(streams.replay, "replay", lambda *given: asked.append(given))
    streams.record_stream(spark, str(tmp_path))
    _, path, schema, files = asked[0]
    written = spark.read.schema(schema).parquet(path)
    assert files == 5 and written.count() == 200 and len(written.inputFiles()) == 4 * 5


def test_append_likes(spark):
    base = spark.createDataFrame([("a", ["i1", "i2"], [100, 50])], "user_id string, items array<string>, seconds array<long>")
    likes = spark.createDataFrame([("a", f"l{n}", n) for n in range(9)] + [("b", "x", 1)], "user_id string, item_id string, position int")
    row = history.append_likes(base, likes).collect()
    assert len(row) == 1 and row[0]["items"] == ["i2"] + [f"l{n}" for n in range(9)]
    assert row[0]["seconds"] == [50] + [100 + 172_800] * 9


def test_drift_watch_waits_for_enough_rows(spark, tmp_path):
    schema = "user_id string, item_id string, rating double, event_ts timestamp, main_category string, price double"
    rows = [(f"u{n % 3}", "i", float(n % 5), None, "c", 1.0) for n in range(10)]
    df = spark.createDataFrame(rows, schema).withColumn("event_ts", F.timestamp_seconds(F.col("rating").cast("long")))
    source = str(tmp_path / "in")
    reports = str(tmp_path / "reports")

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        drift.start_drift_watch(stream, df, str(tmp_path / "stage"), reports, str(tmp_path / "cp"), 15).awaitTermination()

    df.coalesce(1).write.mode("append").parquet(source)
    run()
    assert not (tmp_path / "reports").exists()
    df.coalesce(1).write.mode("append").parquet(source)
    run()
    report = spark.read.parquet(f"{reports}/closed=1")
    assert report.count() == 6 and report.first()["n_rows"] == 20 and report.where("detected").isEmpty()
    df.coalesce(1).write.mode("append").parquet(source)
    run()
    assert len(list((tmp_path / "reports").glob("closed=*"))) == 1


def test_durable_needs_a_shared_folder(spark):
    from ratingloom.session import durable, shared_folder

    assert durable(spark.range(5)).count() == 5
    assert shared_folder(spark)


def test_snapshot_reads_begin_at_the_newest_full_folder(spark, tmp_path):
    path, keys, order = str(tmp_path / "s"), ["k"], ["t"]
    for number in range(7):
        batch = spark.createDataFrame([(number % 3, number, f"v{number}")], "k long, t long, v string")
        upsert_latest(batch, number, path, keys, order, compact_every=3)
        upsert_latest(batch, number, path, keys, order, compact_every=3)  # a batch that runs again changes nothing
    rows = read_snapshot(spark, path, keys, order)
    assert {r.k: r.v for r in rows.collect()} == {0: "v6", 1: "v4", 2: "v5"}
    assert len({f.split("/")[-2] for f in rows.inputFiles()}) == 2  # the full folder of batch 5, and batch 6
    assert {r.k: r.v for r in read_snapshot(spark, path, keys, order, before=2).collect()} == {0: "v0", 1: "v1"}
    assert read_snapshot(spark, str(tmp_path / "none"), keys, order) is None
