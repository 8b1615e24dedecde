"""Clusters: scores for given labels, k-means, projection, assignment."""

from __future__ import annotations

import json

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from tideline.catalogue.registry import query
from tideline import presets as P
from tideline.operators.clusters import (
    CLUSTER, ClusterSuite, Sweep, assign_cluster, calinski_harabasz, cluster_pipeline,
    cluster_points, cluster_profiles, inertia, kmeans_fit, kmeans_sweep, load_clusters,
    nearest_centre, pca_project, save_clusters, silhouette_euclidean, silhouette_squared, vectors,
)
from tideline.operators.lloyd import fit_from
from tideline.operators.stages import NearestCentre, fit_scale
from tideline.plans.observations import customer_features, read_table
from tideline.session import scratch_path, stable

FEATURES = ["c_acctbal", "n_orders", "mean_price", "n_closed"]
ELEMENTS = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
  generate_subscripts(embedding, 1) AS axis FROM embeddings),
m AS (SELECT label, axis, count(*) AS n, avg(x) AS mean, var_pop(x) * count(*) AS ss
  FROM e GROUP BY 1, 2)"""


def _embeddings(spark, sf):
    return read_table(spark, sf, "embeddings").withColumn(
        "embedding", F.col("embedding").cast("array<double>")
    )


@query("inertia", f"WITH {ELEMENTS} SELECT round_even(sum(ss), 2) AS inertia FROM m")
def _(spark, sf):
    return inertia(_embeddings(spark, sf), "label", "embedding")


@query(
    "calinski_harabasz",
    f"""WITH {ELEMENTS}, g AS (SELECT axis, avg(x) AS grand FROM e GROUP BY 1),
    s AS (SELECT sum(ss) AS w, sum(n * (mean - grand) ** 2) AS b,
      count(DISTINCT label) AS k FROM m JOIN g USING (axis))
    SELECT round_even((b / (k - 1)) / (w / ((SELECT count(*) FROM embeddings) - k)), 2)
      AS calinski_harabasz FROM s""",
)
def _(spark, sf):
    return calinski_harabasz(_embeddings(spark, sf), "label", "embedding")


SCORE = """
a AS (SELECT id, max(CASE WHEN own THEN n END) AS n, max(CASE WHEN own THEN total / nullif(n - 1, 0)
    END) AS a, min(CASE WHEN NOT own THEN total / n END) AS b FROM t GROUP BY 1)
SELECT round_even(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette
FROM a"""


@query(
    "silhouette_euclidean",
    f"""WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings),
    t AS (SELECT p.id, p.label = q.label AS own, q.label, count(*) AS n,
      sum(list_distance(p.x, q.x)) AS total FROM v p, v q GROUP BY 1, 2, 3), {SCORE}""",
)
def _(spark, sf):
    return silhouette_euclidean(_embeddings(spark, sf), "vec_id", "label", "embedding")


@query(
    "silhouette_squared",
    f"""WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings),
    t AS (SELECT p.id, p.label = q.label AS own, q.label, count(*) AS n,
      sum(list_distance(p.x, q.x) ** 2) AS total FROM v p, v q GROUP BY 1, 2, 3), {SCORE}""",
)
def _(spark, sf):
    rows = _embeddings(spark, sf).withColumn("v", array_to_vector("embedding"))
    return silhouette_squared(rows, "label", "v")


_sweeps: dict[tuple, Sweep] = {}
_tables: dict[tuple, DataFrame] = {}


def _customers(spark, sf) -> DataFrame:
    """The customers, joined once with their orders and written; all queries of a session read that."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _tables:
        _tables[key] = stable(customer_features(spark, sf))
    return _tables[key]


def _swept(spark, sf) -> Sweep:
    """One sweep serves all queries of a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _sweeps:
        _sweeps[key] = kmeans_sweep(_customers(spark, sf), "c_custkey", FEATURES, 2, 6)
    return _sweeps[key]


def _placed(spark, sf):
    rows = vectors(_customers(spark, sf), FEATURES)
    return _swept(spark, sf).model.transform(rows)


def _profiles(spark, sf):
    rows = _placed(spark, sf).withColumn("late", (F.col("n_closed") > 5).cast("int"))
    return cluster_profiles(
        rows, sports="n_orders", food="c_nationkey", library="n_closed", index="c_acctbal",
        exam="late", event="late", slot="c_mktsegment",
    )


@query("kmeans_fit")
def _(spark, sf):
    rows = vectors(_customers(spark, sf), FEATURES)
    model = kmeans_fit(rows, 3)
    return model.transform(rows).groupBy(CLUSTER).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in FEATURES]
    )


STARTS = (((5.0, 10.0), (45.0, 70.0)), ((5.0, 5.0), (25.0, 40.0), (50.0, 90.0)))
START_ROWS = ", ".join(
    f"({s}, {c}, {q}::DOUBLE, {p}::DOUBLE)" for s, cs in enumerate(STARTS) for c, (q, p) in enumerate(cs)
)


@query(
    "kmeans_rounds",
    f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS n, l_quantity AS q,
      l_extendedprice / 1000 AS p FROM lineitem),
    c AS (SELECT 0 AS r, * FROM (VALUES {START_ROWS}) t(s, c, q, p)
      UNION ALL SELECT r + 1, s, m, avg(q), avg(p) FROM
        (SELECT c.r, c.s, d.n, arg_min(c.c, (d.q - c.q) ** 2 + (d.p - c.p) ** 2) AS m,
          any_value(d.q) AS q, any_value(d.p) AS p FROM c, d WHERE c.r < 5 GROUP BY 1, 2, 3)
      GROUP BY r, s, m)
    SELECT s AS fit, c AS cluster, round_even(q, 4) AS quantity, round_even(p, 4) AS price
    FROM c WHERE r = 5""",
)
def _(spark, sf):
    # two fits from given centres, five rounds of both in the same five scans
    lines = read_table(spark, sf, "lineitem")
    points = lines.select(
        F.array("l_quantity", F.col("l_extendedprice") / 1000).cast("array<double>").alias("point")
    )
    fits = fit_from(points, STARTS, rounds=5, tol=0.0)
    rows = [(i, c, float(q), float(p)) for i, f in enumerate(fits) for c, (q, p) in enumerate(f.centres)]
    out = spark.createDataFrame(rows, "fit int, cluster int, quantity double, price double")
    return out.withColumns({c: F.rint(F.col(c) * 1e4) / 1e4 for c in ("quantity", "price")})


CENTRES = ((-1.0, -1.0), (0.4, 0.2), (1.3, 1.5))


@query(
    "saved_clusters",
    f"""WITH z AS (SELECT l_orderkey, l_linenumber, l_extendedprice,
        (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
        (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS b
      FROM lineitem),
    p AS (SELECT *, (SELECT arg_min(c, (a - x) ** 2 + (b - y) ** 2) FROM (VALUES
      {", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(CENTRES))}) t(c, x, y)) AS cluster
      FROM z)
    SELECT l_orderkey, l_linenumber, l_extendedprice, cluster,
      CASE cluster WHEN 0 THEN 'small' WHEN 1 THEN 'usual' ELSE '{P.UNKNOWN_PERSONA}' END AS label,
      CASE cluster WHEN 0 THEN 'few and cheap' WHEN 1 THEN 'most lines' ELSE '' END AS description,
      round_even((a + b) / sqrt(2), 3) AS pca_1 FROM p""",
)
def _(spark, sf):
    # of two standardised, positively correlated columns the first axis is their mean direction
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    scale = fit_scale(lines, ["l_quantity", "l_extendedprice"])
    profiles = spark.createDataFrame(
        [(0, "small", "few and cheap", "a"), (1, "usual", "most lines", "b")],
        "cluster int, label string, description string, recommended_action string",
    )
    projection = pca_project(scale.transform(lines), 2)
    centres = NearestCentre(centres=json.dumps(CENTRES))
    suite = ClusterSuite(
        cluster_pipeline(scale, centres, profiles, projection), [], 3, projection.variance
    )
    loaded = load_clusters(spark, save_clusters(spark, suite, scratch_path(spark, "clusters")))
    return loaded.assign(lines).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", CLUSTER, "label", "description", "pca_1"
    )


@query("kmeans_sweep")
def _(spark, sf):
    # fitted each time, so that its time is that of the sweep
    return kmeans_sweep(_customers(spark, sf), "c_custkey", FEATURES, 2, 6).frame(spark)


@query("pca_project")
def _(spark, sf):
    rows = vectors(_customers(spark, sf), FEATURES)
    projection = pca_project(rows, 2)
    return projection.apply(rows).select("c_custkey", "pca_1", "pca_2")


@query(
    "pca_variance",
    """WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
    SELECT 1::INT AS component, round_even((1 + r) / 2, 4) AS explained_variance FROM c
    UNION ALL SELECT 2::INT, round_even((1 - r) / 2, 4) FROM c""",
)
def _(spark, sf):
    # of two standardised columns the axes explain (1 + |r|) / 2 and (1 - |r|) / 2
    rows = vectors(read_table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return pca_project(rows, 2).frame(spark)


@query("cluster_profiles")
def _(spark, sf):
    return _profiles(spark, sf)


@query(
    "cluster_profiles_given",
    """WITH t AS (SELECT c_nationkey % 4 AS cluster, c_acctbal AS s, c_custkey % 300 AS f,
      c_mktsegment AS slot FROM customer),
    n AS (SELECT cluster, slot, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC,
      slot) AS r FROM t GROUP BY 1, 2)
    SELECT cluster, count(*) AS sample_count, round_even(count(*)
      / (SELECT count(*) FROM t)::DOUBLE * 100, 1) AS percentage_of_data,
      round_even(avg(s), 1) AS avg_sports_load_pct, round_even(avg(f), 1) AS avg_food_orders,
      any_value(n.slot) AS predominant_time_slot FROM t JOIN n USING (cluster) WHERE r = 1
    GROUP BY 1""",
)
def _(spark, sf):
    rows = read_table(spark, sf, "customer").select(
        (F.col("c_nationkey") % 4).alias("cluster"), "c_acctbal",
        (F.col("c_custkey") % 300).alias("food"), "c_mktsegment", F.lit(0).alias("flag"),
    )
    out = cluster_profiles(
        rows, sports="c_acctbal", food="food", library="c_acctbal", index="c_acctbal",
        exam="flag", event="flag", slot="c_mktsegment",
    )
    return out.select(
        "cluster", "sample_count", "percentage_of_data", "avg_sports_load_pct",
        "avg_food_orders", "predominant_time_slot",
    )


@query("cluster_points")
def _(spark, sf):
    placed = _placed(spark, sf)
    return cluster_points(
        placed, _profiles(spark, sf), pca_project(placed, 2), ["c_custkey"],
        ["c_custkey", "c_mktsegment", "n_orders"],
    )


@query("assign_cluster")
def _(spark, sf):
    suppliers = read_table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("c_acctbal"), F.lit(10).alias("n_orders")
    )
    placed = _placed(spark, sf)
    out = assign_cluster(
        suppliers, FEATURES, _customers(spark, sf), _swept(spark, sf).model, _profiles(spark, sf),
        pca_project(placed, 2),
    )
    return out.select("s_suppkey", CLUSTER, "label", "pca_1", "pca_2")


@query(
    "nearest_centre",
    """WITH c AS (SELECT * FROM (VALUES (0, 10.0::DOUBLE, 20000.0::DOUBLE), (1, 25.0, 50000.0),
      (2, 40.0, 80000.0)) t(cluster, q, p)),
    d AS (SELECT l_orderkey, l_linenumber, l_extendedprice, cluster,
      sqrt((l_quantity - q) ** 2 + (l_extendedprice - p) ** 2) AS d FROM lineitem, c)
    SELECT l_orderkey, l_linenumber, l_extendedprice, arg_min(cluster, d) AS cluster,
      round_even(min(d), 4) AS distance FROM d GROUP BY ALL""",
)
def _(spark, sf):
    centres = {0: (10.0, 20000.0), 1: (25.0, 50000.0), 2: (40.0, 80000.0)}
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    out = nearest_centre(lines, ["l_quantity", "l_extendedprice"], centres)
    return out.drop("l_quantity").withColumn("distance", F.rint(F.col("distance") * 1e4) / 1e4)
