"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from tideline.catalogue import QUERIES
from tideline.operators.association import corr_matrix
from tideline.operators.distribution import describe_stats, iqr_outliers
from tideline.operators.flow import chrono_split
from tideline.operators.ordering import ranks_by_row
from tideline.plans.observations import read_table
from tideline.session import stable


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "observations", "ingest_file", "describe_stats", "iqr_outliers", "corr_pearson",
    "corr_spearman", "lag_feature", "transition_matrix", "confusion_matrix", "recommended_slots",
    "explain_factors", "standardize", "group_profile", "impute",
])
def test_no_cross_joins_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in text


def test_fences_and_days_reach_the_scan(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    text = plan(iqr_outliers(lines, "l_quantity", 0.1, F.lit("x"), ["l_orderkey"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "LessThan(l_quantity" in pushed and "GreaterThan(l_quantity" in pushed
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    dated = read_table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    assert plan(chrono_split(dated, ["d", "o_orderkey"])).count("Window") == 0


def test_only_needed_columns_are_read(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan(describe_stats(lines, ["l_tax"]))))
    assert schemas == {"l_tax:double"}


def test_top_k_is_cut_before_the_shuffle(spark, sf):
    text = plan(QUERIES["top_k_per_group"](spark, sf))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("deletion", ["listwise", "pairwise"])
@pytest.mark.parametrize("columns", [2, 5])
def test_spearman_moves_rows_twice(spark, monkeypatch, columns, deletion):
    """One range shuffle for all lists and one regroup, however many columns."""
    written = []
    monkeypatch.setattr(
        "tideline.operators.ordering.stable", lambda df: written.append(plan(df)) or stable(df)
    )
    df = spark.range(300).select(*[((F.col("id") * (i + 3)) % (7 + i)).alias(f"c{i}") for i in range(columns)])
    result = plan(corr_matrix(df, df.columns, "spearman", deletion))
    before, ranked = written
    assert "Exchange" not in before
    assert ranked.count("Exchange rangepartitioning") == 1 and ranked.count("Exchange") == 1
    # what follows moves rows by their number once; the rest are sums, one row a partition, list or hot value
    assert result.count("Exchange hashpartitioning(row") == 1
    small = re.findall(r"Exchange (hashpartitioning\(list|SinglePartition|hashpartitioning\(_part)", result)
    others = result.count("Exchange ") - result.count("BroadcastExchange ") - result.count("ReusedExchange ")
    assert others - len(small) == 1


@pytest.mark.parametrize("columns", [["a"], ["a", "b"], ["a", "b", "x"], ["x", "b", "y"]])
def test_few_values_are_ranked_by_counting(spark, monkeypatch, columns):
    written = []
    monkeypatch.setattr(
        "tideline.operators.ordering.stable", lambda df: written.append(plan(df)) or stable(df)
    )
    i = F.col("id")
    df = spark.range(9000).select(
        F.when(i % 11 > 0, (i * 7 % 4).cast("double")).alias("a"), (F.sqrt(i % 3) - 1).alias("b"),
        F.when(i % 5 > 0, (i * 7919 % 8999).cast("double")).alias("x"), (i * 31 % 5000).cast("double").alias("y"),
    )
    got = ranks_by_row(df, [F.col(c) for c in columns])
    want = df.toPandas()[columns].rank().dropna(how="all").astype(object)
    want = want.where(want.notna(), None)
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.to_numpy().tolist()), key=key)
    # only lists of many values are moved by range, and only two or more of these by row
    wide = [c for c in columns if c in "xy"]
    assert sum("Exchange rangepartitioning" in p for p in written) == (1 if wide else 0)
    assert ("Exchange hashpartitioning(row" in plan(got)) == (len(wide) > 1)


def test_spearman_splits_a_hot_value(spark):
    rows = [(float(i % 3 == 0), float(i * 7919 % 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, y double")
    pdf = df.toPandas()
    got = ranks_by_row(df, [F.col("x"), F.col("y")]).collect()
    assert sorted(r.rank0 for r in got) == sorted(pdf.x.rank())
    assert sorted(r.rank1 for r in got) == sorted(pdf.y.rank())
    (r,) = [r.r for r in corr_matrix(df, ["x", "y"], "spearman", digits=None).collect() if r.a < r.b]
    assert r == pytest.approx(pdf.corr("spearman").loc["x", "y"], abs=1e-9)
