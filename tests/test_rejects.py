"""Files with different headers under one path, and the cells that cannot be read."""

import os

from tideline.sources.rejects import read_checked

SCHEMA = "day date, visitors int, load double, note string"


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def test_rows_and_rejects(spark, tmp_path, rows):
    write(tmp_path, "a.csv", "day,visitors,load,note\n2024-01-01,5,1.5,fine\n\nsoon,many,x,\"a, b\"\n2024-01-02,,NaN,\n")
    write(tmp_path, "b.csv", "﻿note,extra, visitors ,day\r\nn,1,7,2024-02-30\r\nshort\r\no,2, 8 ,2024-03-01,beyond\r\n")
    write(tmp_path, "c.csv", "")
    write(tmp_path, "d.csv", "day,day\n2024-05-05,never\n")
    got, bad = read_checked(spark, str(tmp_path), SCHEMA)
    name = lambda r: os.path.basename(r[0])
    assert got.columns == ["day", "visitors", "load", "note", "file", "line"]
    seen = {(name((r.file,)), r.line): (str(r.day), r.visitors, r.load, r.note) for r in got.collect()}
    assert seen == {
        ("a.csv", 2): ("2024-01-01", 5, 1.5, "fine"), ("a.csv", 4): ("None", None, None, "a, b"),
        ("a.csv", 5): ("2024-01-02", None, None, None), ("b.csv", 2): ("None", 7, None, "n"),
        ("b.csv", 3): ("None", None, None, "short"), ("b.csv", 4): ("2024-03-01", 8, None, "o"),
        ("d.csv", 2): ("2024-05-05", None, None, None)}
    assert sorted((name(r), *r[1:]) for r in rows(bad)) == [
        ("a.csv", 4, "day", "soon"), ("a.csv", 4, "load", "x"), ("a.csv", 4, "visitors", "many"),
        ("b.csv", 2, "day", "2024-02-30")]


def test_lines_are_counted_across_splits(spark, tmp_path):
    n = 40_000
    for k in range(2):
        write(tmp_path, f"{k}.csv", "k,v\n" + "".join(f"{i},{'bad' if i % 10_007 == 3 else i}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 32_768)
    try:
        got, bad = read_checked(spark, str(tmp_path), "k int, v int")
        assert got.where("line <> k + 2").count() == 0 and got.count() == 2 * n
        assert got.select("file", "line").distinct().count() == 2 * n
        assert sorted((r.line, r.text) for r in bad.collect()) == sorted(
            [(i + 2, "bad") for i in range(n) if i % 10_007 == 3] * 2)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
