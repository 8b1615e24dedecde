import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tideline import presets as P
from tideline.plans.ingest import HISTORY, LAGS, conform, ingest
from tideline.plans.observations import (
    event_cells, observations, raw_uploads, read_table, site_observations,
)
from tideline.streaming.live import (
    clean_rows, event_stream, pulse_windows, read_pulse, stream_append, stream_pulse,
)

SCHEMA = "event_id long, ts timestamp_ntz, event_type string, user_id long, value double"
CAPACITIES = {"sports": 10, "food": 10, "library": 10}


def write(spark, folder, rows):
    """One file per call, so that each is a batch of its own."""
    data = [(i, dt.datetime.fromisoformat(ts), kind, 1, 1.0) for i, ts, kind in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_append_drops_repeated_ids(spark, tmp_path, rows):
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    write(spark, folder, [(1, "2026-01-01T08:00", "view"), (2, "2026-01-01T09:00", "view")])
    run = lambda: stream_append(
        event_stream(spark, folder, SCHEMA), out, marks, "ts", "event_id").awaitTermination()
    run()
    write(spark, folder, [(2, "2026-01-01T09:00", "view"), (3, "2026-01-02T09:00", "click")])
    run()
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (2,), (3,)]


def test_append_keeps_rows_of_any_age(spark, tmp_path, rows):
    """Files in reverse order of time, one a batch, and one file twice."""
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    march = [(1, "2026-03-01T08:00", "view"), (2, "2026-03-09T09:00", "view")]
    for batch in (march, [(3, "2026-02-01T08:00", "view")], [(4, "2025-01-01T08:00", "view")], march):
        write(spark, folder, batch)
        stream_append(
            event_stream(spark, folder, SCHEMA, per_trigger=1), out, marks, "ts", "event_id"
        ).awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (2,), (3,), (4,)]


def test_append_keeps_all_rows_without_an_id(spark, tmp_path, rows):
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    nameless = [(None, "2026-03-01T08:00", "view"), (None, "2026-03-01T08:00", "view")]
    for batch in ([(1, "2026-03-01T08:00", "view"), *nameless], nameless[:1], [(1, "2026-01-01T08:00", "view")]):
        write(spark, folder, batch)
        stream_append(event_stream(spark, folder, SCHEMA), out, marks, "ts", "event_id").awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (None,), (None,), (None,)]


def test_append_costs_its_batch(spark, tmp_path):
    """Neither the rows read nor the state written follow the table."""
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    write(spark, folder, [(i, "2026-01-01T08:00", "view") for i in range(2000)])
    run = lambda: stream_append(event_stream(spark, folder, SCHEMA), out, marks, "ts", "event_id")
    run().awaitTermination()
    write(spark, folder, [(i, "2026-01-02T08:00", "view") for i in (5, 7777)])
    second = run()
    second.awaitTermination()
    progress = second.lastProgress
    assert progress["numInputRows"] <= 4  # two rows, by two branches
    (state,) = [s for s in progress["stateOperators"]]
    assert state["numRowsUpdated"] == 1 and state["numRowsTotal"] == 2001
    assert "rocksdb" in str(state["customMetrics"]).lower()
    assert spark.read.parquet(out).count() == 2001


def test_append_survives_a_batch_that_fails(spark, tmp_path, rows):
    """Files of a batch that never was committed are not part of the table."""
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    write(spark, folder, [(1, "2026-03-01T08:00", "view"), (2, "2026-03-01T08:00", "view")])
    broken = lambda df: df.withColumn(
        "value", F.when(F.col("event_id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("value"))
    )
    query = stream_append(event_stream(spark, folder, SCHEMA), out, marks, "ts", "event_id", broken)
    try:
        query.awaitTermination()
        raise AssertionError("the batch should have failed")
    except StreamingQueryException:
        pass
    stream_append(event_stream(spark, folder, SCHEMA), out, marks, "ts", "event_id").awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (2,)]


def test_late_rows_change_their_cell(spark, tmp_path):
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    run = lambda: stream_pulse(
        event_stream(spark, folder, SCHEMA), CAPACITIES, out, marks).awaitTermination()
    write(spark, folder, [(1, "2026-01-01T08:30", "view"), (2, "2026-01-01T09:00", "view"),
                          (3, "2026-01-09T17:00", "click")])
    run()
    write(spark, folder, [(4, "2026-01-01T08:45", "view"), (5, "2026-01-20T10:00", "view")])
    run()
    got = {(r.date, r.starting_hour): r for r in read_pulse(spark, out).collect()}
    assert got["2026-01-01", 8].sports_visitor_count == 3
    assert got["2026-01-09", 17].library_load_pct == 10.0
    assert got["2026-01-20", 10].sports_visitor_count == 1
    assert len(got) == 3


def test_stream_equals_batch_for_all_days(spark, sf, tmp_path):
    events = read_table(spark, sf, "events")
    query = stream_pulse(event_stream(spark, f"{sf}/events*.parquet", events.schema), CAPACITIES,
                         str(tmp_path / "out"), str(tmp_path / "marks"))
    query.awaitTermination()
    got = read_pulse(spark, str(tmp_path / "out"))
    want = pulse_windows(events, CAPACITIES).select(got.columns)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_clean_rows_equals_ingest(spark):
    """Supplied loads, index, preparation and stage are kept alike; only lags, ids and history differ."""
    upload = spark.createDataFrame(
        [("2024-03-05", "8:00", "80", "33.3", "12.0", "150", "Mid-Term", "90"),
         ("03/06/2024", "17:30", "75", None, None, None, "Finals", "400"),
         ("soon", "10:15", "x", "140.5", "143.87", "10", "Early", "12")],
        "date string, time_slot string, sports_visitor_count string, sports_load_pct string, "
        "campus_pulse_index string, food_prepared_qty string, semester_stage string, "
        "food_orders_demand string")
    batch = ingest(upload, ["starting_hour"], "2024-03-05", label=P.SUBMIT_LABEL)
    table_wide = {"record_id", *LAGS, *[name for name, _, _ in HISTORY]}
    live = clean_rows(upload, "2024-03-05", today="2024-03-05")
    live = conform(live.withColumns({c: F.lit(None).cast("string") for c in table_wide}))
    same = [c for c in batch.columns if c not in table_wide]
    assert {r.starting_hour for r in live.collect()} == {8, 10, 17}
    assert len(same) > 40
    key = lambda r: r.starting_hour
    assert sorted(live.select(same).collect(), key=key) == sorted(
        batch.select(same).collect(), key=key)


def test_clean_rows_is_row_wise(spark, sf):
    raw = raw_uploads(read_table(spark, sf, "events"))
    whole = clean_rows(raw, "2024-01-01", {"sports_hist_avg_crowd": 50.0}, keep=("site_no",))
    part = clean_rows(raw.where(F.col("`Site No.`") == "7"), "2024-01-01",
                      {"sports_hist_avg_crowd": 50.0}, keep=("site_no",))
    again = whole.where("site_no = '7'")
    assert part.count() > 0 and part.exceptAll(again).count() == 0
    assert whole.where("sports_hist_avg_crowd = 50.0").count() == whole.count()


def test_observations_add_up(spark, sf):
    events = read_table(spark, sf, "events")
    views = events.where("event_type = 'view'").count()
    assert observations(event_cells(events)).agg(F.sum("sports_visitor_count")).first()[0] == views
    assert site_observations(events).agg(F.sum("sports_visitor_count")).first()[0] == views
