import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tideline.operators.clusters import load_clusters
from tideline.operators.models import (
    FOOD_SUITE, LIBRARY_SUITE, REGRESSORS, SPORTS_SUITE, load_suite,
)
from tideline.plans.batch import batch_tables, clean_table
from tideline.plans.ingest import ingest
from tideline.plans.observations import raw_uploads, read_table
from tideline.sources.reports import summary_json


@pytest.fixture(scope="module")
def table(spark, sf):
    raw = raw_uploads(read_table(spark, sf, "events"))
    done = ingest(raw, ["date", "starting_hour", "site_no"], keep=["site_no"])
    # a planted rule, so that there is something to learn
    return done.drop("site_no").withColumn(
        "temperature", 15 + F.col("starting_hour") * 0.5
    ).cache()


def test_clean_table(table):
    gaps = table.withColumn("temperature", F.when(F.col("starting_hour") > 3, F.col("temperature")))
    out = clean_table(gaps)
    assert out.where("temperature is null").count() == 0
    row = out.where("starting_hour = 6").first()
    assert (round(row.hour_sin, 9), round(row.hour_cos, 9)) == (1.0, 0.0)


def test_whole_batch(table, spark, tmp_path):
    small = [replace(s, trees=3, rounds=2, regressors=tuple(REGRESSORS[:2]))
             for s in (SPORTS_SUITE, FOOD_SUITE, LIBRARY_SUITE)]
    results = batch_tables(table, suites=small, k_range=(2, 3), restarts=1, models_path=str(tmp_path / "models"))
    path = summary_json(results, str(tmp_path / "summary"))
    counts = {r.section: r["count"] for r in spark.read.text(path).groupBy("section").count().collect()}
    assert counts["dataset"] == 1 and counts["descriptive"] == 9 and counts["tests"] == 6
    assert counts["pearson"] == counts["spearman"] == 81
    assert counts["cluster_scores"] == 2 and counts["cluster_points"] == 200
    assert counts["models"] == 3 * 2 + 3 + 2 + 2
    assert 1 <= counts["advice_sports"] <= 3
    assert counts["advice_food"] == 1 and counts["index_weights"] == 4
    assert counts["cluster_variance"] == 2
    fits = {(r.suite, r.candidate) for r in results["importances"].collect()}
    assert {s for s, _ in fits} == {"sports", "food", "library"}
    # candidates of a one-class target are reported, not fitted
    models = results["models"].where("NOT coalesce(degenerate, false)")
    assert fits == {(r.suite, r.candidate) for r in models.collect()}
    advice = results["advice_food"].first()
    assert advice.recommended_preparation_qty >= 10 and advice.waste_risk in ("Low", "Moderate", "High")
    # what was saved places rows as the batch did
    clusters = load_clusters(spark, str(tmp_path / "models/clusters"))
    assert clusters.best_k == results["cluster_scores"].where("is_best").first().k
    again = clusters.assign(table).select("record_id", "cluster", "pca_1", "pca_2")
    shown = results["cluster_points"].select("record_id", "cluster", "pca_1", "pca_2")
    assert shown.exceptAll(again).count() == 0
    assert counts["cluster_axes"] == table.count() and counts.get("explanations", 0) >= 0
    assert load_suite(spark, small[0], str(tmp_path / "models/sports")).models
    first = json.loads(spark.read.text(f"{path}/section=dataset").first().value)
    assert first["total_records"] == table.count()
    assert first["train_records"] == int(table.count() * 0.8)
