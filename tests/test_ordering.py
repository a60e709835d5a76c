import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvane.functions.ordering import with_global_rank, with_group_carry, with_running_total


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    # key 0 holds most rows
    data = [(i, 0 if rng.random() < 0.6 else rng.randrange(6), rng.randrange(50)) for i in range(3000)]
    frame = pd.DataFrame(data, columns=["id", "k", "v"])
    return spark.createDataFrame(frame).repartition(7), frame


def test_global_rank(rows):
    df, frame = rows
    got = with_global_rank(df, F.col("v").desc(), F.col("id")).toPandas().sort_values("rank")
    want = frame.sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist()
    assert got["rank"].tolist() == list(range(1, len(frame) + 1))


def test_running_total(rows):
    df, frame = rows
    got = with_running_total(df, "v", F.col("id"), name="t").toPandas().sort_values("id")
    want = frame["v"].cumsum() - frame["v"]
    assert got["t"].tolist() == want.tolist()


@pytest.mark.parametrize("kind", ["min", "last", "count"])
def test_group_carry_of_a_hot_key(rows, kind):
    df, frame = rows
    got = with_group_carry(df, "k", "id", "id", "v", kind, "c").toPandas().sort_values("id")
    groups = frame.groupby("k")["v"]
    want = {
        "min": lambda: frame.groupby("k")["v"].transform(lambda s: s.cummin().shift()),
        "last": lambda: groups.shift(),
        "count": lambda: frame.groupby("k").cumcount(),
    }[kind]()
    a = [None if pd.isna(x) else int(x) for x in got["c"]]
    b = [None if pd.isna(x) else int(x) for x in want]
    assert a == b
