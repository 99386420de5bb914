import math
import random

import numpy as np
import pytest

from tessella.operators.percentiles import selected_percentiles

PS = (0, 2.5, 5, 50, 95, 100)


@pytest.mark.parametrize("limit", [1, 20, 10**6])
def test_equal_to_numpy(spark, limit):
    r = random.Random(limit)
    groups = {"flat": [r.random() for _ in range(3000)], "ties": [float(r.choice([1, 1, 1, 1, 5, 9])) for _ in range(2000)], "skew": [math.exp(8 * r.random()) for _ in range(2500)], None: [3.0, 4.0], "one": [7.0], "nan": [1.0, float("nan"), 2.0], "same": [2.0] * 500}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("flat", None), ("void", None)], "g string, value double").repartition(5)
    got = {row.g: row for row in selected_percentiles(df, ["g"], PS, limit, accuracy=100).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        want = np.percentile(vs, PS)
        assert np.allclose([got[g][n] for n in ("p0", "p2.5", "p5", "p50", "p95", "p100")], want, equal_nan=True), (g, got[g], want)


def test_without_keys(spark):
    df = spark.range(1001).selectExpr("cast(id as double) value")
    assert tuple(selected_percentiles(df, [], (5, 50), 10, accuracy=40).first()) == (50.0, 500.0)
