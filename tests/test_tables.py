import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline import presets as P
from tideline.operators.audit import duplicate_count, null_audit, schema_profile
from tideline.operators.mapping import (
    coalesce_derived, coerce_numeric, default_columns, fill_all, impute, map_categories,
    map_columns, normalize_names,
)
from tideline.operators.rows import latest, listwise, search_rows, top_features, top_k_per_group
from tideline.plans.ingest import ingest, upload_facts
from tideline.sources.reports import sanitize, summary_json, summary_rows
from tideline.sources.tables import (
    append_rows, append_table, assign_record_id, first_existing, read_observations, write_split,
    write_table,
)
from tideline.sources.versions import State, VersionedTable


def test_every_canonical_name_is_its_own_first_alias(spark):
    names = set(StructType.fromDDL(P.OBSERVATION_SCHEMA).names)
    assert len(names) == 58
    for name, aliases in P.COLUMN_ALIASES.items():
        assert aliases[0] == name and name in names
    assert len(P.COLUMN_ALIASES) == 36


def test_normalize_names_keeps_the_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, x int, `a-B` int")
    out = normalize_names(df)
    assert out.columns == ["a_b", "x"] and tuple(out.first()) == (3, 2)


def test_map_columns_prefers_the_first_alias(spark):
    df = spark.createDataFrame([(1, 2, 3)], "visitors int, `Sports Crowd` int, month int")
    out = map_columns(df)
    assert out.columns == ["sports_visitor_count"] and out.first()[0] == 2


def test_defaults_and_numbers(spark):
    df = spark.createDataFrame([("12.9",), ("x",), (None,)], "starting_hour string")
    out = coerce_numeric(default_columns(df, {"rain_flag": 0}), {"starting_hour": 14, "other": 3})
    assert [tuple(r) for r in out.collect()] == [(12, 0, 3), (14, 0, 3), (14, 0, 3)]


def test_coalesce_derived(spark):
    df = spark.createDataFrame([("1.26", 5.0), (None, 6.0), ("x", 7.0)], "v string, d double")
    assert [r.v for r in coalesce_derived(df, "v", F.col("d")).collect()] == [1.3, 6.0, 7.0]
    assert [r.v for r in coalesce_derived(df, "v", F.col("d"), 2, 50.0).collect()] == [
        1.26, 50.0, 50.0]
    empty = df.withColumn("v", F.lit(None).cast("string"))
    assert [r.v for r in coalesce_derived(empty, "v", F.col("d"), 2, 50.0).collect()] == [
        5.0, 6.0, 7.0]
    assert [r.w for r in coalesce_derived(df, "w", F.col("d")).collect()] == [5.0, 6.0, 7.0]


def test_impute(spark):
    rows = [(1, "b", 1.0), (None, "a", None), (4, "b", 3.0), (7, "a", 5.0), (2, None, None)]
    df = spark.createDataFrame(rows, "n int, s string, x double")
    out = impute(df)
    assert out.schema["n"].dataType.simpleString() == "double"
    assert [tuple(r) for r in out.collect()] == [
        (1.0, "b", 1.0), (3.0, "a", 3.0), (4.0, "b", 3.0), (7.0, "a", 5.0), (2.0, "a", 3.0)]
    train = df.where("x >= 3 or x is null")
    assert impute(df, ["x"], train).collect()[1].x == 4.0
    assert impute(df.where("n = 1")).schema == df.schema


def test_fill_and_recode(spark):
    df = spark.createDataFrame([(None, None, "Fest"), (1, "x", "Mid")], "a int, b string, c string")
    assert tuple(fill_all(df).first()) == (0, "0", "Fest")
    assert [r.c for r in map_categories(df, "c", P.STAGE_RECODE).collect()] == ["Late", "Mid"]


def test_audits(spark, rows):
    df = spark.createDataFrame(
        [(1, None), (1, None), (1, "a"), (2, None), (1, None)], "n int, s string")
    assert rows(null_audit(df)) == [("(all)", 4), ("n", 0), ("s", 4)]
    assert duplicate_count(df).first()[0] == 2
    assert duplicate_count(df.where("false")).first()[0] == 0
    assert rows(schema_profile(df), "column", "type", "rows", "non_null") == [
        ("n", "int", 5, 5), ("s", "string", 5, 1)]


def test_row_listings(spark, rows):
    df = spark.createDataFrame(
        [(1, "Monday", 5.0), (2, None, 4.0), (3, "Sunday", 4.0)], "id int, d string, x double")
    assert rows(search_rows(df, "MON", ["d", "id"]), "id") == [(1,)]
    assert rows(search_rows(df, "3", ["d", "id"]), "id") == [(3,)]
    assert [r.id for r in latest(df, ["id"], 2).collect()] == [3, 2]
    assert listwise(df, ["d"]).count() == 2
    best = top_k_per_group(df.withColumn("g", F.lit(1)), ["g"], ["x", "id"], 2)
    assert rows(best, "id", "rank") == [(2, 1), (3, 2)]
    feats = df.select(F.col("id").cast("string").alias("feature"), F.col("x").alias("importance"))
    assert [r.feature for r in top_features(feats, 2).collect()] == ["1", "2"]


def test_record_ids_grow(spark):
    df = spark.range(10002)
    ids = assign_record_id(df, ["id"]).orderBy("id").collect()
    assert ids[0].record_id == "CIQ-0001" and ids[-1].record_id == "CIQ-10002"


def test_append(spark, rows):
    old = assign_record_id(spark.createDataFrame([(5,), (6,)], "a int"), ["a"])
    new = spark.createDataFrame([(1, "x")], "a int, b string")
    both = append_table(old, new, ["a"])
    assert rows(both, "record_id", "a", "b") == [
        ("CIQ-0001", 5, None), ("CIQ-0002", 6, None), ("CIQ-0003", 1, "x")]
    more = append_rows(old.withColumn("data_source_label", F.lit("T")), [{"a": 9}, {"a": 7}])
    assert rows(more, "record_id", "a", "data_source_label") == [
        ("CIQ-0001", 5, "T"), ("CIQ-0002", 6, "T"), ("CIQ-0003", 9, P.SUBMIT_LABEL),
        ("CIQ-0004", 7, P.SUBMIT_LABEL)]


def test_read_and_write(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 1), ("b", float("nan"), 2)], "s string, x double, n int")
    for form in ("csv", "parquet", "json", "orc"):
        path = write_table(df, str(tmp_path / form), form=form)
        back = read_observations(spark, path, df.schema, form)
        assert rows(back) == [("a", 1.5, 1), ("b", None, 2)]
    split = df.withColumn("split", F.when(F.col("n") == 1, "train").otherwise("test"))
    path = write_split(split, str(tmp_path / "split"))
    assert spark.read.parquet(f"{path}/split=train").first().s == "a"
    with pytest.raises(AnalysisException):
        read_observations(spark, str(tmp_path / "none.csv"))
    assert first_existing(spark, ["/none/x.csv", path]) == path
    with pytest.raises(FileNotFoundError):
        first_existing(spark, ["/none/x.csv"])


def test_csv_columns_go_by_name(spark, rows, tmp_path):
    for name, text in (("a", "library,sports,other\n7,99,x\n"), ("b", "sports\n1\nbad\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    paths = [str(tmp_path / f"{n}.csv") for n in "ab"]
    got = read_observations(spark, paths, "sports int, library int")
    assert rows(got) == [(1, None), (99, 7), (None, None)]
    with pytest.raises(Exception, match="header"):
        read_observations(spark, str(tmp_path / "*.csv"), "sports int, library int").collect()


def test_mixed_day_formats_are_ingested(spark):
    days = ["2024-03-04", "03/05/2024", "6 Mar 2024", "soon"]
    df = spark.createDataFrame([(d, 8 + i) for i, d in enumerate(days)],
                               "date string, starting_hour int")
    out = {r.starting_hour: r.date for r in ingest(df, ["starting_hour"]).collect()}
    assert [out[8], out[9], out[10]] == ["2024-03-04", "2024-03-05", "2024-03-06"]
    assert len(out) == 4
    assert upload_facts(df, "2024-01-01")["unread_days"] == 1


def test_summary(spark, tmp_path):
    df = spark.createDataFrame([(float("inf"), "a"), (None, "b"), (2.0, "c")], "x double, s string")
    assert [r.x for r in sanitize(df).collect()] == [0.0, 0.0, 2.0]
    records = [json.loads(r.record) for r in summary_rows({"one": df}).collect()]
    assert records[1] == {"x": 0.0, "s": "b"}
    path = summary_json({"one": df, "two": df.limit(1)}, str(tmp_path / "out"))
    assert spark.read.json(f"{path}/section=two").count() == 1
    assert os.path.isdir(f"{path}/section=one")


UPLOAD = [
    ("2026-08-03", "12:00-14:00", "Mid-Term", "5", "Chess match", "180", 150, "1", 300, 3),
    ("2026-08-03", "17:00-20:00", "Regular", "oops", None, "x", 200, None, None, None),
    ("2026-08-11", "08:00-10:00", "Fest", "2", "fest", None, 0, "2", 10, 1),
]
UPLOAD_COLUMNS = (
    "Date string, `Time Slot` string, `Semester Phase` string, Workload string, "
    "`Event Name` string, `Sports Visitors` string, `Food Orders` int, `Food Risk` string, "
    "Library int, Classes int"
)


def test_ingest_of_a_small_upload(spark):
    out = ingest(spark.createDataFrame(UPLOAD, UPLOAD_COLUMNS))
    assert out.columns == StructType.fromDDL(P.OBSERVATION_SCHEMA).names
    a, b, c = out.orderBy("record_id").collect()
    assert [r.record_id for r in (a, b, c)] == ["EXP-0001", "EXP-0002", "EXP-0003"]
    assert [r.time_slot for r in (a, b, c)] == ["Noon / Lunch", "Evening Peak", "Morning"]
    assert [r.semester_stage for r in (a, b, c)] == ["Mid", "Mid", "Late"]
    assert [r.is_exam_week for r in (a, b, c)] == [1, 0, 0]
    assert [r.academic_workload for r in (a, b, c)] == ["High", "Medium", "Low"]
    assert [r.sports_visitor_count for r in (a, b, c)] == [180, 85, 85]
    assert [r.sports_prev_crowd for r in (a, b, c)] == [180, 180, 85]
    assert [r.library_occupancy for r in (a, b, c)] == [300, 160, 10]
    assert [r.food_prepared_qty for r in (a, b, c)] == [128, 210, 0]
    assert [r.food_risk_category for r in (a, b, c)] == [P.SHORTAGE, P.BALANCED, P.SURPLUS]
    assert [r.semester_week for r in (a, b, c)] == [1, 1, 2]
    assert [r.event_type for r in (a, b, c)] == ["Chess match", "None", "fest"]
    assert [r.expected_event_attendance for r in (a, b, c)] == [80, 0, 80]
    assert [r.sports_load_pct for r in (a, b, c)] == [90.0, 42.5, 42.5]
    assert [r.sports_risk_level for r in (a, b, c)] == ["High", "Low", "Low"]
    assert a.sports_hist_avg_crowd == 116.7 and a.sports_hist_peak_crowd == 180
    assert a.campus_pulse_index == round(0.35 * 90 + 0.3 * 85.7 + 0.25 * 50 + 9, 2)
    assert a.classes_ending_near == 3 and b.classes_ending_near == 2
    assert {r.data_source_label for r in (a, b, c)} == {P.IMPORT_LABEL}
    assert out.count() == 3 and all(v is not None for r in (a, b, c) for v in r)


def test_ingest_keeps_given_numbers(spark):
    df = spark.createDataFrame(
        [("2026-08-03", "Night", "21", "55.55", "44.4", 1), ("2026-08-04", "Noon", "x", None, None, 0)],
        "date string, slot string, hour string, sports_load string, cpi string, weekend int")
    a, b = ingest(df).orderBy("date").collect()
    assert (a.time_slot, a.starting_hour, b.time_slot, b.starting_hour) == ("Night", 21, "Noon", 14)
    assert (a.sports_load_pct, b.sports_load_pct) == (55.6, 42.5)
    assert (a.campus_pulse_index, b.campus_pulse_index) == (44.4, 50.0)
    assert (a.is_weekend, b.is_weekend) == (1, 0)


def test_ingest_of_an_empty_upload(spark):
    with pytest.raises(ValueError):
        ingest(spark.createDataFrame([], "date string, hour int"))
    with pytest.raises(ValueError):
        ingest(spark.createDataFrame([(1,)], "nothing_known int"))


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def numbers(df):
    return sorted((r.record_id, r.x) for r in df.collect())


def test_versions_stay_readable(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.state() == State()
    with pytest.raises(FileNotFoundError):
        table.read()
    one = table.replace(frame(spark, "ba"), ["x"])
    two = table.append(frame(spark, "c"), ["x"])
    table.submit([{"x": "d", "note": "n"}, {"x": None}])
    table.append(frame(spark, ""), ["x"])  # no rows, no numbers
    last = table.replace(frame(spark, "z"), ["x"])
    assert numbers(table.read(one.version)) == [("CIQ-0001", "a"), ("CIQ-0002", "b")]
    assert numbers(table.read(two.version))[-1] == ("CIQ-0003", "c")
    told = {r.record_id: r for r in table.read(last.version - 1).collect()}
    assert (told["CIQ-0004"].x, told["CIQ-0004"].note) == ("d", "n")
    assert told["CIQ-0005"].x is None and told["CIQ-0001"].data_source_label is None
    assert told["CIQ-0005"].data_source_label == P.SUBMIT_LABEL and "_no" not in told["CIQ-0005"]
    assert numbers(table.read()) == [("CIQ-0001", "z")] and last.next == 2


def test_writers_never_share_a_number(spark, tmp_path):
    path = str(tmp_path / "t")
    VersionedTable(spark, path).replace(frame(spark, "ab"), ["x"])
    add = lambda i: VersionedTable(spark, path).append(frame(spark, [f"{i}-{k}" for k in range(3)]), ["x"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(6)))
    rows = numbers(VersionedTable(spark, path).read())
    assert [r[0] for r in rows] == [f"CIQ-{i:04d}" for i in range(1, 21)]
    for k in range(2, 20, 3):  # each writer's rows have its own range, in order
        assert [x.split("-")[1] for _, x in rows[k : k + 3]] == ["0", "1", "2"]


def test_a_record_is_never_overwritten(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, "a"), ["x"])
    assert not table._put(State(version=1, next=99))
    assert table.state().next == 2
    left = [n for n in os.listdir(tmp_path / "t" / "_versions") if not n.endswith(".crc")]
    assert left == ["000000000001.json"]


def test_append_begun_before_a_replacement_is_numbered_anew(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, "abcd"), ["x"])
    pending = table.begin(frame(spark, "xy"), ["x"])
    table.replace(frame(spark, "k"), ["x"])
    pending.publish()
    assert numbers(table.read()) == [("CIQ-0001", "k"), ("CIQ-0002", "x"), ("CIQ-0003", "y")]


def test_a_writer_that_dies_leaves_a_gap_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, "a"), ["x"])
    table.begin(frame(spark, "bc"), ["x"])
    table.append(frame(spark, "d"), ["x"])
    assert numbers(table.read()) == [("CIQ-0001", "a"), ("CIQ-0004", "d")]
