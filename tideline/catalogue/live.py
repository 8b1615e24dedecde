"""Streams, run until the given files are used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalogue.registry import PULSE, SLOT_HOUR, query
from tideline.plans.observations import raw_uploads, read_table
from tideline.session import scratch_path
from tideline.sources.tables import write_table
from tideline.streaming.live import (
    clean_rows, event_stream, read_pulse, stream_append, stream_pulse,
)

CAPACITIES = {"sports": 120, "food": 60, "library": 120}


@query(
    "stream_append",
    """WITH e AS (SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type, value, day(ts) >= 28 AS again
      FROM events)
    SELECT * EXCLUDE (again) FROM e
    UNION ALL SELECT * EXCLUDE (again) FROM e WHERE event_id IS NULL AND again""",
)
def _(spark, sf):
    # newest days first, the newest once more at the end, each feed after a restart;
    # every tenth row has no id and so counts as often as it comes
    events = read_table(spark, sf, "events").withColumn(
        "event_id", F.expr("CASE WHEN event_id % 10 <> 0 THEN event_id END")
    )
    folder, out, marks = (scratch_path(spark, n) for n in ("feeds", "append", "marks"))
    days = F.dayofmonth("ts")
    feeds = ((days >= 20) | days.isNull(), days.between(10, 19), days < 10, days >= 28)
    for number, part in enumerate(feeds):
        write_table(events.filter(part), f"{folder}/feed{number}")
        rows = event_stream(spark, f"{folder}/*", events.schema)
        stream_append(rows, out, marks, "ts", "event_id").awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type", "value"
    )


@query(
    "stream_uploads",
    """WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS h,
      count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'click') AS c
      FROM events GROUP BY 1, 2, 3)
    SELECT CAST(user_id AS VARCHAR) AS site_no, strftime(day, '%Y-%m-%d') AS date,
      dayname(day) AS day_of_week, h::INT AS starting_hour,
      CAST(CASE WHEN c > 0 THEN v * 60 ELSE 85 END AS INT) AS sports_visitor_count,
      round_even(CASE WHEN c > 0 THEN v * 60 ELSE 85 END / 200::DOUBLE * 100, 1)
        AS sports_load_pct, round_even((c * 120 + 40) / 350::DOUBLE * 100, 1)
        AS library_load_pct FROM c""",
)
def _(spark, sf):
    uploads = raw_uploads(read_table(spark, sf, "events"))
    folder = write_table(uploads, scratch_path(spark, "uploads"), form="json")
    rows = event_stream(spark, folder, uploads.schema, "json").withColumnRenamed(
        " Observation Date", "date"
    )
    clean = clean_rows(rows, "2024-01-01", keep=("site_no",))
    keyed = clean.withColumns(
        {
            "at": F.to_timestamp("date"),
            "id": F.concat_ws("/", "site_no", "date", F.col("starting_hour").cast("string")),
        }
    )
    out, marks = scratch_path(spark, "clean"), scratch_path(spark, "marks")
    stream_append(keyed, out, marks, "at", "id").awaitTermination()
    return spark.read.parquet(out).select(
        "site_no", "date", "day_of_week", "starting_hour", "sports_visitor_count",
        "sports_load_pct", "library_load_pct",
    )


@query(
    "stream_pulse",
    f"""WITH c AS (SELECT CAST(ts AS DATE) AS day, {SLOT_HOUR} AS starting_hour,
      CAST(count(*) FILTER (event_type = 'view') AS INT) AS sports_visitor_count,
      CAST(count(*) FILTER (event_type = 'purchase') AS INT) AS food_orders_demand,
      CAST(count(*) FILTER (event_type = 'click') AS INT) AS library_occupancy,
      CAST(count(*) FILTER (event_type = 'signup') AS INT) AS classes_ending_near,
      CAST(count(*) FILTER (event_type = 'error') AS INT) AS errors
      FROM events GROUP BY 1, 2),
    l AS (SELECT *, round_even(sports_visitor_count / 120::DOUBLE * 100, 1) AS sports_load_pct,
      round_even(library_occupancy / 120::DOUBLE * 100, 1) AS library_load_pct FROM c),
    p AS (SELECT *, round_even(least(100.0::DOUBLE, greatest(0.0::DOUBLE,
      0.35::DOUBLE * sports_load_pct + 0.30::DOUBLE * library_load_pct + 0.25::DOUBLE
      * least(100.0::DOUBLE, food_orders_demand / 60::DOUBLE * 100) + 0.10::DOUBLE * 60)), 2)
      AS campus_pulse_index FROM l)
    SELECT strftime(day, '%Y-%m-%d') AS date, p.* EXCLUDE (day),
      {PULSE.format(c='campus_pulse_index')} AS campus_activity_status FROM p""",
)
def _(spark, sf):
    schema = read_table(spark, sf, "events").schema
    events = event_stream(spark, f"{sf}/events*.parquet", schema)
    out, marks = scratch_path(spark, "pulse"), scratch_path(spark, "marks")
    stream_pulse(events, CAPACITIES, out, marks).awaitTermination()
    return read_pulse(spark, out)
