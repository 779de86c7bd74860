"""Streaming job vs batch job on the same event log."""

import json
import os
import random
import shutil
import tempfile
import time
from datetime import datetime, timedelta

import pytest
from conftest import event
from pyspark.sql import functions as F

from tripcast.config import DEFAULT_RULES as R
from tripcast.operators import enrich, metrics as M
from tripcast.plans import batch
from tripcast.sources import fixtures
from tripcast.sources.events import TopicSource
from tripcast.streaming import jobs

SF = "/root/testdata/sf0.001"
CHUNKS = 6


def write_topic_files(spark, log, topic, folder):
    """One text file per event-time chunk, oldest first, with increasing modification times."""
    rows = (log.where(F.col("topic") == topic).select("event_time", "value")
            .orderBy("event_time", "value").collect())
    os.makedirs(folder)
    size = (len(rows) + CHUNKS - 1) // CHUNKS
    for i in range(CHUNKS):
        path = os.path.join(folder, f"part-{i:03d}.txt")
        with open(path, "w") as fh:
            for r in rows[i * size:(i + 1) * size]:
                fh.write(r.value + "\n")
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


@pytest.fixture(scope="module")
def streamed(spark):
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("no test data")
    work = tempfile.mkdtemp(prefix="tripcast-stream-")
    log = fixtures.event_log_fixture(spark, SF, R)
    write_topic_files(spark, log, R.pickup_topic, os.path.join(work, "pickups"))
    write_topic_files(spark, log, R.dropoff_topic, os.path.join(work, "dropoffs"))
    out = os.path.join(work, "out")
    trig = {"availableNow": True}
    pick = TopicSource(R.pickup_topic, format="text", path=os.path.join(work, "pickups"), max_files_per_trigger=1)
    drop = TopicSource(R.dropoff_topic, format="text", path=os.path.join(work, "dropoffs"), max_files_per_trigger=1)
    qs = jobs.start_trip_query(spark, pick, drop, out, R, trigger=trig, checkpoint_root=os.path.join(work, "ckpt"))
    for q in qs:
        q.awaitTermination(600)
    gq = jobs.start_gauge_query(spark, pick, drop, out, R, trigger=trig, checkpoint_root=os.path.join(work, "ckpt"))
    gq.awaitTermination(600)
    iq = jobs.start_invalid_query(spark, out, R, trigger=trig, checkpoint_root=os.path.join(work, "ckpt"))
    iq.awaitTermination(600)
    zones = fixtures.zone_fixture(spark, SF)
    mq = jobs.start_metric_queries(spark, zones, out, R, trigger=trig, checkpoint_root=os.path.join(work, "ckpt"))
    for q in mq:
        q.awaitTermination(600)
    return work, out


def test_streaming_trips_equal_batch(spark, streamed):
    work, out = streamed
    got = spark.read.parquet(os.path.join(out, "trips"))
    want = batch.build_from_fixture(spark, SF, R, close="watermark").trips
    cols = ["trip_id", "invalid_reason", "pickup_datetime", "dropoff_datetime", "duration_seconds",
            "passenger_count", "total_amount", "event_time"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)


def test_streaming_rejected_equal_batch(spark, streamed):
    work, out = streamed
    got = spark.read.parquet(os.path.join(out, "rejected_events")).select("topic", "reason", "raw_payload")
    t = batch.build_from_fixture(spark, SF, R)
    want = t.rejected.distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def closed_windows(spark, out):
    """Metric rows of the batch job over the streamed trips, of the windows that their own watermark closes."""
    t = batch.build_from_fixture(spark, SF, R, close="watermark")
    valid = spark.read.parquet(os.path.join(out, "trips")).where("is_valid")
    last = valid.agg((F.max("event_time") - F.expr("INTERVAL 30 SECONDS")).alias("w")).first().w
    rows = M.all_metrics(enrich.enrich_trips(valid, fixtures.zone_fixture(spark, SF), R), R, F.lit(last).cast("timestamp"))
    assert t.metrics().count() > 0
    return {(r.metric_name, r.window_start, r.window_end, r.dimension): r.value for r in rows.collect()}


def streamed_windows(spark, out):
    rows = spark.read.parquet(os.path.join(out, "aggregates")).where("metric_name <> 'open_trips'")
    return {(r.metric_name, r.window_start, r.window_end, r.dimension): r.value for r in rows.collect()}


def test_streaming_windows_equal_batch(spark, streamed):
    """Exactly the closed windows, each with the batch value; sliding ones come from two chained aggregations."""
    work, out = streamed
    want = closed_windows(spark, out)
    assert streamed_windows(spark, out) == want and {k[0] for k in want} >= {"trips_last_h", "trip_count_by_borough", "trips_per_week"}


def test_replay_is_idempotent(spark, streamed):
    work, out = streamed
    from tripcast.sinks import writers
    path = os.path.join(out, "rejected_events")
    before = spark.read.parquet(path).count()
    epochs = sorted({r.epoch for r in spark.read.parquet(path).select("epoch").distinct().collect()})
    replay = spark.read.parquet(os.path.join(path, f"epoch={epochs[0]}"))
    assert writers.write_epoch(replay, path, epochs[0]) is False  # a replayed epoch writes nothing
    assert spark.read.parquet(path).count() == before


def test_streaming_gauge_equals_batch(spark, streamed):
    work, out = streamed
    got = spark.read.parquet(os.path.join(out, "aggregates")).where("metric_name = 'open_trips'").drop("window_date")
    assert got.count() > 0
    want = batch.build_from_fixture(spark, SF, R, close="watermark").open_trips()
    g = {r.window_end: r.value for r in got.collect()}
    w = {r.window_end: r.value for r in want.collect()}
    assert set(g) == set(w)
    assert g == w


def test_streaming_invalid_trips_first_emitted(spark, streamed):
    from tripcast.sinks import writers
    work, out = streamed
    got = spark.read.parquet(os.path.join(out, "invalid_trips")).select("trip_id", "invalid_reason")
    streamed_trips = spark.read.parquet(os.path.join(out, "trips"))
    want = writers.first_invalid(streamed_trips).select("trip_id", "invalid_reason")
    assert got.count() == got.select("trip_id").distinct().count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def text_topic(folder, chunks):
    """A topic of text files, one per micro-batch, oldest first."""
    os.makedirs(folder)
    for i, events in enumerate(chunks):
        path = os.path.join(folder, f"part-{i:03d}.txt")
        with open(path, "w") as fh:
            fh.writelines(json.dumps(e) + "\n" for e in events)
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    return folder


def at(minute, second=0):
    return (datetime(2023, 5, 17, 6, 40) + timedelta(minutes=minute, seconds=second)).isoformat()


def topics(work, pickups, dropoffs):
    """Sources over chunks of (trip id, minute, second) per side."""
    made = []
    for topic, side, chunks in ((R.pickup_topic, "pickup", pickups), (R.dropoff_topic, "dropoff", dropoffs)):
        events = [[event(side, trip_id=i, **{f"{side}_datetime": at(m, s)}) for i, m, s in chunk] for chunk in chunks]
        made.append(TopicSource(topic, format="text", path=text_topic(os.path.join(work, side), events), max_files_per_trigger=1))
    return made


def batch_of(spark, sources):
    read = [spark.read.text(s.path) for s in sources]
    return batch.build(*read, spark.createDataFrame([(23, "South", "z", "y")], "location_id int, borough string, zone string, service_zone string"), R)


REPEATED = ([[("a", 0, 0), ("a", 5, 0), ("b", 6, 0)], [("a", 20, 0), ("c", 22, 0)], [("c", 24, 0), ("z", 9000, 0)]],
            [[("a", 10, 0), ("a", 12, 0)], [("b", 21, 0), ("c", 21, 30)], [("b", 25, 0), ("c", 3500, 0), ("z", 9001, 0)]])


def test_streaming_pairs_repeated_events_as_batch(spark, tmp_path):
    sources = topics(str(tmp_path), *REPEATED)
    out = str(tmp_path / "out")
    for q in jobs.start_trip_query(spark, *sources, out, R, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt")):
        q.awaitTermination(300)
    cols = ["trip_id", "invalid_reason", "pickup_datetime", "dropoff_datetime", "event_time"]
    got = sorted(map(str, spark.read.parquet(os.path.join(out, "trips")).select(*cols).collect()))
    want = sorted(map(str, batch_of(spark, sources).trips.select(*cols).collect()))
    assert got == want and len(want) > 6


def test_streaming_gauge_out_of_order_and_its_state_ends(spark, tmp_path):
    rng = random.Random(2)
    pickups, dropoffs = [], []
    for k in range(40):  # events up to 25 s late, over micro-batches
        pickups.append((f"t{k}", 3 * k, rng.randrange(60)))
        if k % 4:
            dropoffs.append((f"t{k}", 3 * k + rng.randrange(-20, 260), rng.randrange(60)))
    late = lambda e: 60 * e[1] + e[2] + rng.randrange(25)
    far = ("far", 5000, 0)
    chunk = lambda rows, lo, hi: [r for r in rows if lo <= r[3] < hi]
    arrived = [[(*e, late(e)) for e in side] for side in (pickups, dropoffs)]
    cuts = [-10 ** 6, 1500, 3000, 4500, 6000, 10 ** 6]
    sides = [[[r[:3] for r in chunk(rows, lo, hi)] for lo, hi in zip(cuts, cuts[1:])] + [[far]] for rows in arrived]
    sources = topics(str(tmp_path), *sides)
    out = str(tmp_path / "out")
    q = jobs.start_gauge_query(spark, *sources, out, R, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = {r.window_end: r.value for r in spark.read.parquet(os.path.join(out, "aggregates")).collect()}
    want = {r.window_end: r.value for r in batch_of(spark, sources).open_trips().collect()}
    assert got == want and len(want) > 200
    # two days later nothing of the trips is left in the state; the last pickup and dropoff are not over yet
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(rows) > 100 and rows[-1] <= 12


def test_files_of_a_failed_attempt_are_no_trips(spark, tmp_path):
    """Part files that no commit names stay out of the table and of the metrics."""
    sources = topics(str(tmp_path), *REPEATED)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    trig = {"availableNow": True}
    for q in jobs.start_trip_query(spark, *sources, out, R, trigger=trig, checkpoint_root=ckpt):
        q.awaitTermination(300)
    table = os.path.join(out, "trips")
    n = spark.read.parquet(table).count()
    for f in [f for f in os.listdir(table) if f.endswith(".parquet")]:
        shutil.copy(os.path.join(table, f), os.path.join(table, f"part-lost-{f}"))
    assert spark.read.parquet(table).count() == n
    zones = spark.createDataFrame([(23, "South", "z", "y")], "location_id int, borough string, zone string, service_zone string")
    for q in jobs.start_metric_queries(spark, zones, out, R, trigger=trig, checkpoint_root=ckpt):
        q.awaitTermination(300)
    rows = spark.read.parquet(os.path.join(out, "aggregates")).where("metric_name = 'trip_count_by_borough'").collect()
    assert [(r.dimension, r.value) for r in rows] == [("South", float(spark.read.parquet(table).where("is_valid and event_time < '2023-05-18'").count()))]


def test_stop_and_restart_gives_what_one_run_gives(spark, tmp_path):
    """The first run sees two files a topic; the second one goes on from its checkpoint."""
    sources = topics(str(tmp_path), *REPEATED)
    out, ckpt, trig = str(tmp_path / "out"), str(tmp_path / "ckpt"), {"availableNow": True}
    held = []
    for s in sources:
        held.append((os.path.join(s.path, "part-002.txt"), str(tmp_path / f"held-{s.topic}")))
        shutil.copy2(*held[-1])
        os.truncate(held[-1][0], 0)
        os.rename(held[-1][0], os.path.join(s.path, "_part-002.txt"))  # hidden from the reader
    for _ in range(2):
        for q in (*jobs.start_trip_query(spark, *sources, out, R, trigger=trig, checkpoint_root=ckpt),
                  jobs.start_gauge_query(spark, *sources, out, R, trigger=trig, checkpoint_root=ckpt)):
            q.awaitTermination(300)
        for path, copy in held:
            shutil.copy2(copy, path)
    t = batch_of(spark, sources)
    cols = ["trip_id", "invalid_reason", "pickup_datetime", "dropoff_datetime", "event_time"]
    assert sorted(map(str, spark.read.parquet(os.path.join(out, "trips")).select(*cols).collect())) == sorted(map(str, t.trips.select(*cols).collect()))
    got = {r.window_end: r.value for r in spark.read.parquet(os.path.join(out, "aggregates")).collect()}
    assert got == {r.window_end: r.value for r in t.open_trips().collect()}


def test_table_readers_start_before_the_first_trip(spark, tmp_path):
    out = str(tmp_path / "out")
    q = jobs.start_invalid_query(spark, out, R, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt"))
    q.awaitTermination(60)
    assert q.exception() is None
    assert os.path.isdir(os.path.join(out, "trips"))


def test_duplicates_are_ignored_however_late_and_leave_no_state(spark, tmp_path):
    bad = [f"{{broken {k}" for k in range(6)]
    folder = tmp_path / "pickup"
    folder.mkdir()
    for i, chunk in enumerate([bad[:3] + bad[:1], bad[2:5], bad]):
        (folder / f"part-{i}.txt").write_text("\n".join(chunk) + "\n")
        os.utime(folder / f"part-{i}.txt", (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    (tmp_path / "dropoff").mkdir()
    (tmp_path / "dropoff" / "part-0.txt").write_text(bad[0] + "\n")
    sources = [TopicSource(t, format="text", path=str(tmp_path / side), max_files_per_trigger=1)
               for t, side in ((R.pickup_topic, "pickup"), (R.dropoff_topic, "dropoff"))]
    out = str(tmp_path / "out")
    q = jobs.start_trip_query(spark, *sources, out, R, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt"))[1]
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "rejected_events")).collect()
    assert sorted((r.topic, r.raw_payload) for r in got) == sorted([(R.pickup_topic, b) for b in bad] + [(R.dropoff_topic, bad[0])])
    assert all(not p["stateOperators"] for p in q.recentProgress)


def test_late_rows_are_counted(spark, tmp_path):
    pickups = [[("a", 0, 0), ("b", 60, 0)], [("c", 70, 0)], [("late", 10, 0), ("late2", 20, 0), ("d", 80, 0)]]
    dropoffs = [[("b", 65, 0)], [("x", 69, 0)], [("late", 15, 0), ("c", 81, 0)]]
    sources = topics(str(tmp_path), pickups, dropoffs)
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        q = jobs.start_trip_query(spark, *sources, str(tmp_path / "out"), R, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt"))[0]
        q.awaitTermination(300)
        for _ in range(100):
            if late.dropped.get(str(q.id)):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.dropped[str(q.id)] == 3
