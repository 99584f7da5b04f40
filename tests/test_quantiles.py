import random

import numpy as np
import pytest

from lanwatch.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [5.0] * 40, [0.0, -0.0, 1.0, None], [random.Random(1).gauss(0, 1) for _ in range(999)],
                                    [float(random.Random(k).randrange(9)) for k in range(500)]])
def test_against_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    want = np.quantile([v for v in values if v is not None], shares)
    assert exact_quantiles(df, "x", shares) == pytest.approx(list(want))


def test_no_values(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]
