import random

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from footfall.operators import ranking


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_first_rows_of_each_group(spark, n):
    r = random.Random(n)
    data = [("big" if i % 3 else f"g{i % 7}", r.randrange(500), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v bigint, i bigint").repartition(6)
    got = ranking.top_n(df, ["g"], [F.desc("v"), "i"], n)
    wanted = []
    for group in {g for g, _, _ in data}:
        best = sorted((d for d in data if d[0] == group), key=lambda d: (-d[1], d[2]))[:n]
        wanted += [(*d, k + 1) for k, d in enumerate(best)]
    assert rows(got) == sorted(wanted)
