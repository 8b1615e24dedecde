import numpy as np
from pyspark.sql import functions as F

from tideline.operators.clusters import pca_project, vectors


def test_axes_of_almost_equal_variance(spark):
    """Two columns that hardly correlate: rounding in the sums must not turn the axes."""
    step = 1 - 2e-8
    rows = spark.range(200_000, numPartitions=2).select(
        (F.col("id") % 50 + 0.1).alias("a"), ((F.col("id") * 7919) % 99991 * step).alias("b")
    )
    data = vectors(rows, ["a", "b"])
    x = np.array([r[0].toArray() for r in data.select("_vector").collect()]).astype(np.longdouble)
    x -= x.mean(axis=0)
    aa, bb, ab = (x[:, 0] ** 2).mean(), (x[:, 1] ** 2).mean(), (x[:, 0] * x[:, 1]).mean()
    want = np.abs(np.tan(np.arctan2(2 * ab, aa - bb) / 2))
    points = pca_project(data, 2).apply(data, None)
    out = [tuple(r) for r in points.select("pca_1", "pca_2").limit(200).collect()]
    angle = want / np.sqrt(1 + want**2), 1 / np.sqrt(1 + want**2)
    first = data.select("_vector").limit(200).collect()
    for (p, _), r in zip(out, first):
        a, b = r[0]
        near = min(abs(abs(p) - abs(angle[1] * a + s * angle[0] * b)) for s in (1, -1))
        assert near < 1e-10
