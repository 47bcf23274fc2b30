import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketry.schemas import INTERACTIONS_RAW
from basketry.streaming import buffer, contract, jobs, windows

NOW = datetime(2024, 1, 1, 12)
WIRE = "topic string, payload string, arrival timestamp_ntz"


def wire(spark, payloads, topic="transactions"):
    rows = [(topic, p if p is None or isinstance(p, str) else json.dumps(p), NOW)
            for p in payloads]
    return spark.createDataFrame(rows, WIRE)


def event(**change):
    e = {"user_id": 1, "item_id": 2, "view_mode": "view", "rating": 3,
         "timestamp": "2024-01-01T10:00:00.5", "event_id": "a"}
    e.update(change)
    return {k: v for k, v in e.items() if v != "absent"}


@pytest.mark.parametrize("change, reasons", [
    ({}, ""), ({"rating": None}, ""), ({"rating": "absent"}, ""), ({"timestamp": None}, ""),
    ({"user_id": "7"}, ""), ({"user_id": 7.0}, ""), ({"user_id": 7.5}, "user_id"),
    ({"user_id": None}, "user_id"), ({"item_id": "x"}, "item_id"), ({"view_mode": "buy"}, "view_mode"),
    ({"view_mode": "absent"}, "view_mode"), ({"rating": 0}, "rating"), ({"rating": 6}, "rating"),
    ({"rating": "good"}, "rating"), ({"timestamp": "soon"}, "timestamp"),
    ({"item_id": None, "rating": 9}, "item_id,rating")])
def test_transaction_contract(spark, change, reasons):
    got = contract.decode_transactions(wire(spark, [event(**change)])).first()
    assert got.reasons == reasons


def test_malformed_json_and_null_payload(spark):
    decoded = contract.decode_transactions(wire(spark, ['{"user_id": 1, "item', "[]x", None]))
    assert [r.reasons for r in decoded.collect()] == ["json"] * 3
    assert contract.accepted(decoded).count() == 0 and contract.rejected(decoded).count() == 3


def test_absent_timestamp_is_the_arrival(spark):
    rows = contract.accepted(contract.decode_transactions(wire(
        spark, [event(timestamp="absent"), event()]))).orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == [datetime(2024, 1, 1, 10, 0, 0, 500000), NOW]
    assert rows[0].implicit_score == 1


def test_user_contract(spark):
    good = {"user_id": 1, "age": 30, "gender": "M", "device": "Mobile"}
    payloads = [good, {**good, "age": 0}, {**good, "gender": "Male"}, {**good, "device": "Phone"},
                {"user_id": 1}]
    got = [r.reasons for r in contract.decode_users(wire(spark, payloads, "users")).collect()]
    assert got == ["", "age", "gender", "device", "age,gender,device"]


def test_route_and_encode(spark):
    both = wire(spark, [event()]).union(wire(spark, [event()], "users"))
    assert contract.route(both, "users").count() == 1
    df = spark.createDataFrame([(1, 2, NOW)], "user_id long, item_id long, t timestamp_ntz")
    named = df.withColumn("event_id", contract.event_id(F.col("user_id"), F.col("item_id"),
                                                        F.col("t")))
    row = contract.encode_events(named, "transactions", ["user_id", "event_id"], "user_id").first()
    assert (row.key, row.topic) == ("1", "transactions")
    assert json.loads(row.value) == {"user_id": 1, "event_id": "1_2_1704110400000"}


def deliver(spark, folder, payloads):
    wire(spark, payloads).coalesce(1).write.mode("append").parquet(str(folder))


def source(spark, folder, **options):
    return jobs.file_events(spark, str(folder), wire(spark, []).schema, **options)


def test_staging_survives_a_restart(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in", "out", "checkpoint")]
    deliver(spark, paths[0], [event(event_id="a"), event(rating=9)])
    for more in ([], [event(event_id="b")], []):
        if more:
            deliver(spark, paths[0], more)
        decoded = contract.decode_transactions(source(spark, paths[0]))
        jobs.stage_events(decoded, paths[1], paths[2]).awaitTermination()
    staged = spark.read.parquet(paths[1])
    assert sorted(r.event_id for r in staged.collect()) == ["a", "b"]
    raw = spark.createDataFrame([(5, 6, "view", 1, NOW)], INTERACTIONS_RAW)
    both = jobs.with_staged(raw, spark, paths[1], staged.schema)
    assert both.count() == 3 and "event_id" in both.columns


def deduped(spark, tmp_path, files=1):
    decoded = contract.decode_transactions(source(spark, tmp_path / "in", max_files=files))
    unique = contract.identified(decoded)
    out = str(tmp_path / "out")
    jobs.append_unrepeated(unique, out, str(tmp_path / "ck")).awaitTermination()
    return spark.read.schema(unique.schema).parquet(out).collect()


def test_repeats_across_batches(spark, tmp_path):
    for ids in ("ab", "bc", "ca"):
        deliver(spark, tmp_path / "in", [event(event_id=i) for i in ids])
    assert sorted(r.event_id for r in deduped(spark, tmp_path)) == ["a", "b", "c"]
    deliver(spark, tmp_path / "in", [event(event_id=i) for i in "adda"])
    assert sorted(r.event_id for r in deduped(spark, tmp_path)) == ["a", "b", "c", "d"]


def test_no_event_is_lost(spark, tmp_path):
    """Events without id, far behind, and behind one that claims to come from the future."""
    deliver(spark, tmp_path / "in", [event(event_id="absent", item_id=i) for i in range(20)])
    deliver(spark, tmp_path / "in", [event(event_id="f", timestamp="2099-01-01T00:00:00")])
    deliver(spark, tmp_path / "in", [event(event_id=f"o{i}", timestamp=f"2019-01-{i + 1:02d}T00:00:00")
                                     for i in range(9)])
    deliver(spark, tmp_path / "in", [event(event_id="absent", item_id=i) for i in range(3)])
    deliver(spark, tmp_path / "in", [event(event_id="o1", timestamp="2019-01-02T00:00:00")])
    got = deduped(spark, tmp_path)
    assert len(got) == 29 and len({r.event_id for r in got}) == 29
    decoded = contract.decode_transactions(spark.read.parquet(str(tmp_path / "in")))
    assert [r.reasons for r in contract.rejected(decoded).collect()] == ["future"]


def test_dedupe_does_not_read_what_came_before(spark, tmp_path):
    """Over many batches and a restart every batch takes its own rows in, nothing else."""
    for i in range(22):
        deliver(spark, tmp_path / "in", [event(event_id=f"e{i + j}") for j in range(5)])

    def run():
        decoded = contract.decode_transactions(source(spark, tmp_path / "in", max_files=1))
        query = jobs.append_unrepeated(contract.identified(decoded), str(tmp_path / "out"),
                                       str(tmp_path / "ck"))
        query.awaitTermination()
        return [p for p in query.recentProgress if p["numInputRows"]]

    batches = run()
    assert len(batches) == 22
    # The source is read by the two branches, with and without an id.
    assert {p["numInputRows"] for p in batches} <= {5, 10}
    assert batches[-1]["stateOperators"][0]["numRowsTotal"] == 26
    deliver(spark, tmp_path / "in", [event(event_id=f"e{j}") for j in (0, 3, 99, 99)])
    again, = run()
    assert again["numInputRows"] <= 8
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.event_id for r in got) == sorted({f"e{i}" for i in range(26)} | {"e99"})


def at(day, hour=0, **change):
    return event(timestamp=f"2023-12-{day:02d}T{hour:02d}:00:00", event_id="absent", **change)


def refresh(spark, tmp_path, **options):
    valid = contract.accepted(contract.decode_transactions(source(spark, tmp_path / "in", max_files=1)))
    windows.refresh_windows(valid, "item_id", str(tmp_path / "w"), str(tmp_path / "ck"),
                            **options).awaitTermination()
    got = windows.window_counts(spark, "item_id", str(tmp_path / "w")).collect()
    late = windows.late_events(spark, "item_id", str(tmp_path / "w")).collect()
    return ({(r.item_id, r.window_start.day): (r.events, r.purchases, r.rating_sum, r.rating_n)
             for r in got}, sorted((r.item_id, r.timestamp.day) for r in late))


def test_windows_are_refreshed_and_late_events_kept(spark, tmp_path):
    deliver(spark, tmp_path / "in", [at(1), at(1, 5, view_mode="purchase", rating=None), at(2, item_id=9)])
    assert refresh(spark, tmp_path) == ({(2, 1): (2, 1, 3, 1), (9, 2): (1, 0, 3, 1)}, [])
    deliver(spark, tmp_path / "in", [at(20), at(1, 7)])       # in time: the edge was the 2nd
    assert refresh(spark, tmp_path)[0][2, 1] == (3, 1, 6, 2)
    deliver(spark, tmp_path / "in", [at(1, 8), at(2), at(13), at(12)])  # closed by the 20th but one
    counts, late = refresh(spark, tmp_path)
    assert late == [(2, 1), (2, 2), (2, 12)]
    assert counts == {(2, 1): (3, 1, 6, 2), (9, 2): (1, 0, 3, 1), (2, 20): (1, 0, 3, 1),
                      (2, 13): (1, 0, 3, 1)}
    before = sorted(p.name for p in (tmp_path / "w" / "windows").glob("day=*"))
    deliver(spark, tmp_path / "in", [at(20, 3), at(3)])
    counts, late = refresh(spark, tmp_path)
    assert counts[2, 20] == (2, 0, 6, 2) and late == [(2, 1), (2, 2), (2, 3), (2, 12)]
    assert sorted(p.name for p in (tmp_path / "w" / "windows").glob("day=*")) == before
    assert len(list((tmp_path / "w" / "edge").glob("*"))) == 2


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """A batch that failed after it had written is merged again."""
    decoded = lambda rows: contract.accepted(contract.decode_transactions(wire(spark, rows)))
    path = str(tmp_path / "w")
    batches = [[at(1), at(2)], [at(20), at(1), at(2)], [at(1), at(20), at(20)]]
    for n, rows in enumerate(batches):
        for _ in range(1 + n):
            windows.merge_batch(decoded(rows), n, "item_id", path, "1 day", "7 DAYS")
    got = {r.window_start.day: r.events for r in windows.window_counts(spark, "item_id", path).collect()}
    assert got == {1: 2, 2: 2, 20: 3}
    assert windows.late_events(spark, "item_id", path).count() == 1


def test_buffer_flushes_by_number_and_by_time(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("out", "ck")]

    def grouped(seconds):
        return buffer.in_groups(source(spark, tmp_path / "in"), F.length("payload") % 2, 5, seconds)

    deliver(spark, tmp_path / "in", [f"{i:04d}" for i in range(12)])
    query = buffer.append_groups(grouped(3600), *paths)
    buffer.taken_in(query)
    query.stop()  # with two events in the buffer
    first = spark.read.schema(buffer.FLUSHED).parquet(paths[0]).collect()
    assert [(r.n, r.full) for r in first] == [(5, True)] * 2
    deliver(spark, tmp_path / "in", [f"{i:04d}" for i in range(12, 16)] + ["odd"])
    buffer.drain(buffer.append_groups(grouped(1), *paths), 1)
    got = spark.read.schema(buffer.FLUSHED).parquet(paths[0]).orderBy("lane", "flush").collect()
    assert [(r.lane, r.flush, r.n, r.full) for r in got] == [
        (0, 0, 5, True), (0, 1, 5, True), (0, 2, 5, True), (0, 3, 1, False), (1, 0, 1, False)]
    assert sorted(p for r in got for p in r.payloads) == sorted([f"{i:04d}" for i in range(16)] + ["odd"])


def test_folded_counts(spark, tmp_path):
    for modes in (["view", "purchase"], ["view", "add_to_cart"], ["view"]):
        deliver(spark, tmp_path / "in", [event(view_mode=m) for m in modes])
    decoded = contract.decode_transactions(source(spark, tmp_path / "in", max_files=1))
    valid, counts = contract.accepted(decoded), str(tmp_path / "counts")
    jobs.fold_counts(valid, "item_id", counts, str(tmp_path / "ck")).awaitTermination()
    assert len(list((tmp_path / "counts").glob("batch=*"))) == 3
    row = jobs.fresh_item_features(jobs.folded_counts(spark, "item_id", counts)).first()
    assert (row.item_id, row.popularity_score, row.purchase_count, row.view_count) == (2, 5, 1, 3)
    assert row.avg_item_rating == 3.0 and row.view_to_purchase_rate == pytest.approx(1 / 3)
    compact = jobs.compact_counts(spark, "item_id", counts, str(tmp_path / "compact"))
    assert sorted(map(tuple, compact.collect())) == \
        sorted(map(tuple, jobs.folded_counts(spark, "item_id", counts).collect()))
    users = str(tmp_path / "users")
    jobs.fold_counts(valid, "user_id", users, str(tmp_path / "ck-users")).awaitTermination()
    row = jobs.fresh_user_features(jobs.folded_counts(spark, "user_id", users)).first()
    assert (row.user_id, row.user_activity_count, row.purchase_count) == (1, 5, 1)
    assert row.avg_rating_given == 3.0 and row.purchase_ratio == pytest.approx(0.2)


def test_kafka_needs_its_connector(spark):
    """The connector package is not here; the reader must say so, not fail oddly."""
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.kafka_events(spark, "broker:9092", ["users", "transactions"], max_offsets=100)


def test_a_lane_leaves_part_by_part():
    """Full groups leave before the next part is read, so no lane is held whole."""
    import pandas as pd

    class State:
        exists, get = True, (["a"], 0, 7)

        def update(self, value):
            self.value = value

        def setTimeoutDuration(self, millis):
            self.millis = millis

    read, state = [], State()

    def parts():
        for n in range(3):
            read.append(n)
            yield pd.DataFrame({"payload": [f"{n}-{i}" for i in range(10)]})

    step = buffer._collect(4, 1e12)((5,), parts(), state)
    first = next(step)
    assert read == [0] and first["flush"].tolist() == [7, 8] and first["full"].all()
    rest = pd.concat([first, *step])
    assert rest["flush"].tolist() == list(range(7, 14)) and set(rest["n"]) == {4}
    sent = [x for g in rest["payloads"] for x in g] + state.value[0]
    assert sent == ["a"] + [f"{n}-{i}" for n in range(3) for i in range(10)]
    assert state.value[0] == sent[28:] and state.value[2] == 14 and state.millis > 0


def test_one_file_is_spread_over_tasks(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "in"))
    counts = []

    def tasks(batch, _):
        counts.append(batch.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())

    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = jobs.file_events(spark, str(tmp_path / "in"), schema, max_files=1, spread="id")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"  # fifty rows would be one task again
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    stream.writeStream.foreachBatch(tasks).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    spark.conf.set(merged, before)
    assert sum(counts[0]) == 50 and sum(n > 0 for n in counts[0]) > 1
