"""Observations that keep arriving: append and live index."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline import presets as P
from tideline.functions.banding import pulse_level
from tideline.functions.facility import load_pct, pulse_index
from tideline.operators.mapping import map_columns
from tideline.plans.ingest import clean_cells, derive_cells
from tideline.plans.observations import EVENT_COLUMNS, slot_hour

CELL = ["date", "starting_hour"]


def event_stream(
    spark: SparkSession, path: str, schema, form: str = "parquet", per_trigger: int | None = None
) -> DataFrame:
    """A folder of files as a stream.

    A CSV whose header differs from the schema ends the stream; nothing is read by position.
    """
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if form == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(form).load(path)


def clean_rows(
    raw: DataFrame, first_day: str, history: dict[str, float] | None = None,
    keep: Sequence[str] = (), timed: bool | None = None, today: str | datetime.date | None = None,
    label: str = P.SUBMIT_LABEL,
) -> DataFrame:
    """The row-wise part of ingest: no value depends on another row.

    Table-wide values (first day of term, means and peaks) come from a batch
    snapshot.  Where ingest looks at the whole upload, the columns decide: a
    slot column is read as times unless ``timed`` is False, a supply label or an
    index that is there counts as supplied.  Works on a stream and on a batch alike.
    """
    df = map_columns(raw, {**P.COLUMN_ALIASES, **{k: [k] for k in keep}})
    given = set(df.columns)
    timed = "time_slot" in given and timed is not False
    start = F.lit(first_day).cast("date")
    df = clean_cells(df, today or datetime.date.today(), start, timed)
    df = df.withColumns({c: F.lit(v) for c, v in (history or {}).items()})
    return derive_cells(
        df, "food_risk_category" in given, "campus_pulse_index" in given, label
    )


# ids live in RocksDB on the executors' disks; a batch writes its changes only
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def each_once(rows: DataFrame, id: str) -> DataFrame:
    """Rows of a stream, of those with the same id the first to come; rows without an id all stay.

    The state is one entry per id, kept without end, so a row may be of any age.
    Rows without an id are not looked up and leave no state.  (Their branch reads
    the source once more; files of Parquet without a missing id are skipped by
    their statistics.)
    """
    named = rows.filter(F.col(id).isNotNull()).dropDuplicates([id])
    return named.unionByName(rows.filter(F.col(id).isNull()))


def stream_append(
    rows: DataFrame, path: str, checkpoint: str, event_time: str, id: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append new rows to a Parquet table, each id once, however late it comes.

    Exactly once: ids are state of the stream, and the files of a batch belong to
    the table when the batch is committed in its log, which readers go by; a
    batch that is run again after a failure finds the state as it was before and
    replaces its files.  A batch costs its own rows, since nothing that is stored
    is read.  Rows without an id are all appended.  ``prepare`` is a row-wise
    step.  The folder belongs to the stream: rows that exist already come in as
    one more folder of its source.
    """
    stamped = rows.withColumn(event_time, F.col(event_time).cast("timestamp"))
    fresh = each_once(prepare(stamped) if prepare else stamped, id)
    conf = rows.sparkSession.conf
    before = {k: conf.get(k, None) for k in STATE_CONF}
    for key, value in STATE_CONF.items():
        conf.set(key, value)
    try:  # a query takes its settings when it starts
        return (
            fresh.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def pulse_windows(
    events: DataFrame, capacities: dict[str, int], workload: str | Column = "Medium",
    ts: str = "ts",
) -> DataFrame:
    """Counts, loads and index per day and slot.

    There is no watermark: rows count however late they come, and the state is
    one row per slot of a day, whatever the number of events.
    """
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp"))
    counts = [
        F.count_if(F.col("event_type") == kind).cast("int").alias(name)
        for name, kind in EVENT_COLUMNS.items()
    ]
    # slots differ in length, so the window is the day and the slot is a key
    cells = stamped.groupBy(
        F.window(ts, "1 day").alias("window"), slot_hour(F.hour(ts)).alias("starting_hour")
    ).agg(*counts)
    level = workload if isinstance(workload, Column) else F.lit(workload)
    loads = cells.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("date"), "starting_hour",
        *EVENT_COLUMNS,
        load_pct("sports_visitor_count", F.lit(capacities["sports"])).alias("sports_load_pct"),
        load_pct("library_occupancy", F.lit(capacities["library"])).alias("library_load_pct"),
    )
    index = pulse_index(
        "sports_load_pct", "library_load_pct", "food_orders_demand", level,
        ceiling=float(capacities["food"]),
    )
    return loads.withColumn("campus_pulse_index", index).withColumn(
        "campus_activity_status", pulse_level("campus_pulse_index")
    )


def stream_pulse(
    events: DataFrame, capacities: dict[str, int], path: str, checkpoint: str
) -> StreamingQuery:
    """Keep the cells of all days up to date; ``read_pulse`` reads them.

    Every batch replaces the cells it touched, so a batch that is run again after
    a failure changes nothing.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.partitionBy(*CELL).option("partitionOverwriteMode", "dynamic").mode(
            "overwrite"
        ).parquet(path)

    return (
        pulse_windows(events, capacities).writeStream.foreachBatch(put).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_pulse(spark: SparkSession, path: str) -> DataFrame:
    """The cells ``stream_pulse`` wrote; the folder names hold day and slot."""
    cells = spark.read.parquet(path)
    rest = [c for c in cells.columns if c not in CELL]
    return cells.select(
        F.col("date").cast("string"), F.col("starting_hour").cast("int"), *rest
    )
