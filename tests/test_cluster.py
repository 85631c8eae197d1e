"""K-Means, its evaluation and storage."""

import pytest
from compare import bag
from pyspark.sql import functions as F

from arenalake.operators.cluster import fit_clusters, predict, silhouette
from arenalake.registry.prepared import bronze, fitted_model
from arenalake.sinks.models import load_model, save_model
from arenalake.sinks.scratch import scratch_path

SF = "/root/testdata/sf0.001"


def groups(spark):
    """Two separated groups, one ten times the size of the other, with repeats."""
    near = spark.range(200).select((F.col("id") % 7).cast("int").alias("x"), F.lit(0).alias("y"))
    far = spark.range(20).select(
        (F.col("id") % 5 + 1000).cast("int").alias("x"), F.lit(1000).alias("y")
    )
    return near.unionAll(far)


def test_separated_groups(spark):
    rows = groups(spark)
    model = fit_clusters(rows)
    sizes = sorted(r["count"] for r in predict(model, rows).groupBy("prediction").count().collect())
    assert sizes == [20, 200]
    assert silhouette(model, rows) > 0.99


def test_centres_weigh_repeated_positions(spark):
    rows = groups(spark)
    centres = sorted(tuple(c) for c in fit_clusters(rows).stages[-1].clusterCenters())
    means = sorted(
        (r.x, r.y) for r in rows.groupBy(F.col("x") > 500).agg(
            F.avg("x").alias("x"), F.avg("y").alias("y")
        ).collect()
    )
    assert centres == [pytest.approx(m) for m in means]


def test_prediction_is_the_nearest_centre(spark):
    model = fitted_model(spark, SF)
    centres = model.stages[-1].clusterCenters()
    distance = [
        (F.col("x") - float(c[0])) ** 2 + (F.col("y") - float(c[1])) ** 2 for c in centres
    ]
    nearest = F.when(distance[1] < distance[0], 1).otherwise(0)
    scored = predict(model, bronze(spark, SF))
    assert scored.filter(F.col("prediction") != nearest).count() == 0


def test_save_over_and_load(spark):
    path = scratch_path(spark, "model")
    rows = bronze(spark, SF)
    save_model(fit_clusters(rows, k=3), path)
    model = fitted_model(spark, SF)
    save_model(model, path)
    assert bag(predict(load_model(path), rows)) == bag(predict(model, rows))


def test_scored_rows_can_be_scored_and_fitted_again(spark):
    scored = predict(fitted_model(spark, SF), bronze(spark, SF), keep_features=True)
    again = predict(fit_clusters(scored), scored)
    assert "features_vector" not in again.columns
    assert again.count() == scored.count()


@pytest.mark.parametrize("k", [2, 5])
def test_centres_do_not_depend_on_the_partitions(spark, k):
    """On uniform positions, where the first centres decide."""
    rows = spark.range(4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(801)) - 400).cast("int").alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(801)) - 400).cast("int").alias("y"),
    )
    found = []
    for n in (1, 3, 8):
        model = fit_clusters(rows.repartition(n), k=k)
        found.append(sorted(tuple(c) for c in model.stages[-1].clusterCenters()))
    assert found[0] == found[1] == found[2]
