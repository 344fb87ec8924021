from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.numbering import measure_quartiles, quartile, sequence_numbers
from ledgerline.session import shared_dir
from ledgerline.operators.rfm import rfm_measures, rfm_segments, segment_name


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 10, 41])
def test_quartile_equals_quantile_cut(spark, n):
    got = [r[0] for r in spark.range(1, n + 1).orderBy("id").select(quartile(F.col("id"), F.lit(n))).collect()]
    want = [1] if n == 1 else list(pd.qcut(np.arange(1, n + 1), q=4, labels=[1, 2, 3, 4]))
    assert got == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_follow_the_order(spark, partitions):
    shuffled = random.Random(1).sample([(i % 50, i) for i in range(1000)], 1000)
    rows = spark.createDataFrame(shuffled, "k int, v int").repartition(partitions)
    got = sorted((r.n, r.k, r.v) for r in sequence_numbers(rows, ["k"], "n").collect())
    assert [n for n, _, _ in got] == list(range(1, 1001))
    assert [(k, v) for _, k, v in got] == sorted(shuffled)


def test_hot_key_and_copies_are_split(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # the rows here are few
    numbered = sequence_numbers(rows, ["k"], "n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 40_000, 40_000)
    newest = max(Path(shared_dir(spark)).glob("numbering-*"), key=lambda p: p.stat().st_mtime)
    sizes = [r["count"] for r in spark.read.parquet(str(newest)).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 20_000


def test_only_keys_are_ranged_by_hash(spark):
    """Wide rows are written once, with their place; the ranged files hold places alone. Copies and null keys keep a
    number each."""
    rows = [(k, f"w{v}", v) for k in (2, None, 1) for v in (5, 3, 5, None)] * 3
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), "k int, `w.x` string, v int").repartition(5)
    numbered = sequence_numbers(df, ["k"], "S.No", total="all", ties="hash")
    assert numbered.columns == ["k", "w.x", "v", "S.No", "all"]
    got = sorted(map(tuple, numbered.collect()), key=lambda r: r[3])
    assert [r[3:] for r in got] == [(n, 36) for n in range(1, 37)]
    assert [r[0] for r in got] == [None] * 12 + [1] * 12 + [2] * 12
    assert sorted(map(repr, (r[:3] for r in got))) == sorted(map(repr, rows))
    newest = max(Path(shared_dir(spark)).glob("numbering-*"), key=lambda p: p.stat().st_mtime)
    assert spark.read.parquet(str(newest)).columns == ["_copy", "_at"]


def test_empty_input_and_total(spark):
    rows = spark.createDataFrame([], "k int")
    assert sequence_numbers(rows, ["k"], "n", total="all").collect() == []
    three = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    out = sequence_numbers(three, ["k"], "S.No", unique=True, total="all")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 3), (2, 2, 3), (3, 3, 3)]


def test_measures_are_ranked_without_a_single_partition(spark):
    rows = spark.range(500).select(F.col("id").alias("c"), (F.col("id") % 7).cast("double").alias("x"))
    ranked = measure_quartiles(rows, "c", ["x"])
    got = {r.c: r.x_quartile for r in ranked.collect()}
    order = sorted(range(500), key=lambda i: (i % 7, i))
    labels = pd.qcut(np.arange(500), q=4, labels=[1, 2, 3, 4])
    assert got == {c: labels[i] for i, c in enumerate(order)}
    plan = ranked.select("*")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange counts rows per partition.
    assert plan.count("SinglePartition") == 1 and "Python" not in plan


def pandas_segments(data: pd.DataFrame) -> dict:
    run_date = data["d"].max() + pd.Timedelta(days=1)
    per = data.groupby("c").agg(r=("d", lambda x: (run_date - x.max()).days), f=("o", "count"), m=("v", "sum"))

    def labels(name, ordered):
        return pd.qcut(per[name].rank(method="first"), q=4, labels=ordered).astype(int)

    r, f, m = 5 - labels("r", [4, 3, 2, 1]), 5 - labels("f", [1, 2, 3, 4]), 5 - labels("m", [1, 2, 3, 4])
    return {c: f"{r[c]}{f[c]}{m[c]}" for c in per.index}


@pytest.mark.parametrize("customers", [2, 3, 5, 8, 100])
def test_segments_equal_a_pandas_computation(spark, customers):
    rng = random.Random(customers)
    rows = [
        (f"c{rng.randrange(customers):03d}", pd.Timestamp("2020-01-01") + pd.Timedelta(days=rng.randrange(90)), i, float(rng.randrange(5)))
        for i in range(customers * 4)
    ]
    rows += [(f"c{c:03d}", pd.Timestamp("2020-02-01"), 10_000 + c, 1.0) for c in range(customers)]
    data = pd.DataFrame(rows, columns=["c", "d", "o", "v"])
    frame = spark.createDataFrame(data).union(spark.createDataFrame([(None, dt.datetime(2020, 3, 1), 1, 1.0)], "c string, d timestamp, o long, v double"))
    got = {r.customer: r.rfm for r in rfm_segments(frame, "c", "d", "o", "v").collect()}
    assert got == pandas_segments(data)


def test_measures_without_values(spark):
    rows = spark.createDataFrame([("a", "2020-01-01", None, None)], "c string, d string, o long, v double")
    assert tuple(rfm_measures(rows, "c", "d", "o", "v", places=2).first()) == ("a", 1, 0, 0.0)


def test_segment_precedence(spark):
    cases = {"444": "Lost Cheap Customers", "411": "Lost Customers", "311": "Almost Lost Customers", "111": "Best Customers",
             "121": "Big Spenders", "113": "Loyal Customers", "124": "Recent Customers", "234": "Others"}
    rows = spark.createDataFrame([tuple(int(d) for d in code) for code in cases], "r int, f int, m int")
    got = [x[0] for x in rows.select(segment_name(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert got == list(cases.values())
