import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermart.functions import ordering as o


@pytest.fixture(scope="module")
def skewed(spark):
    """Two groups; one value holds a third of the rows."""
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(300, 7.25), rng.lognormal(3, 2, 400), -rng.lognormal(1, 1, 200)])
    rows = [("a", float(v)) for v in values] + [("b", float(v)) for v in values[::7]]
    rows += [("a", None), ("b", float("nan"))]
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(5)


def _present(rows, key):
    return [v for k, v in rows if k == key and v is not None and not math.isnan(v)]


def test_exact_quantiles(skewed):
    rows, df = skewed
    wanted = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q95": 0.95, "top": 1.0}
    found = {r.k: r for r in o.exact_quantiles(df, ["k"], "v", wanted).collect()}
    for key in "ab":
        for name, q in wanted.items():
            assert found[key][name] == pytest.approx(np.quantile(_present(rows, key), q), rel=1e-12)


def test_quantiles_without_keys_and_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)], "v double")
    (row,) = o.exact_quantiles(df, [], "v", {"low": 0.0, "mid": 0.5}).collect()
    assert (row.low, row.mid) == (3.0, 3.0)
    four = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert o.exact_quantiles(four, [], "v", {"q": 0.25}).first().q == 1.75


@pytest.mark.parametrize("by", [lambda c: c, lambda c: F.lit(0), lambda c: F.floor(c)])
def test_spreading_does_not_change_totals(spark, by):
    rng = np.random.default_rng(1)
    rows = [(float(v), int(w)) for v, w in zip(rng.permutation(200) - 77.5, rng.integers(1, 9, 200))]
    df = spark.createDataFrame(rows, "v double, w int")
    placed = o.running_totals(df, [], ["v"], by(F.col("v")), ["w"]).collect()
    total, before = sum(w for _, w in rows), 0
    for r in sorted(placed, key=lambda r: r.v):
        assert (r.w_before, r.w_total) == (before, total)
        before += r.w


def test_positions_are_a_permutation(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.xxhash64("id").alias("h"))
    placed = o.positions(df, ["k"], ["h"], F.col("h")).collect()
    for key in (0, 1):
        group = sorted((r for r in placed if r.k == key), key=lambda r: r.h)
        assert [r.position for r in group] == list(range(500))
        assert {r.group_size for r in group} == {500}


@pytest.mark.parametrize(
    "value", ["id / 200000000", "1700000000 + id", "id / 20000000.0 * 0.01", "concat('CUS_0x', lpad(hex(id), 6, '0'))"]
)
def test_values_close_together_are_spread(spark, value):
    """No bucket is much larger than the mean, however narrow the range or long the common prefix."""
    text = value.startswith("concat")
    df = spark.range(200_000).select(F.lit("g").alias("k"), F.expr(value).alias("v"))
    marked = df.withColumns({"_all": F.lit(0), "_by": F.col("v")})
    cuts = o._cuts(marked, ["k"], text).first()["_cuts"]
    sizes = np.bincount(np.searchsorted(cuts, np.array([r.v for r in df.select("v").collect()])))
    assert len(sizes) >= 64 and sizes.max() <= 8 * sizes.mean()


def test_null_keys_are_a_group_and_null_values_come_first(spark):
    rows = [(None, 1.0), (None, None), ("a", 2.0), ("a", 1.0), (None, 0.5)]
    placed = o.positions(spark.createDataFrame(rows, "k string, v double"), ["k"], ["v"], F.col("v")).collect()
    assert sorted((str(r.k), str(r.v), r.position) for r in placed) == [
        ("None", "0.5", 1), ("None", "1.0", 2), ("None", "None", 0), ("a", "1.0", 0), ("a", "2.0", 1)
    ]


def _pairs_auc(rows):
    positive = [s for s, y in rows if y == 1]
    negative = [s for s, y in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return won / (len(positive) * len(negative))


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(2)
    rows = [(round(float(s), 1), int(y)) for s, y in zip(rng.random(150), rng.integers(0, 2, 150))]
    df = spark.createDataFrame(rows, "s double, y int")
    assert o.roc_auc(df, [], "s", "y").first().auc == pytest.approx(_pairs_auc(rows))


def test_auc_of_all_ties_and_of_one_class(spark):
    ties = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0)], "s double, y int")
    assert o.roc_auc(ties, [], "s", "y").first().auc == 0.5
    single = spark.createDataFrame([(0.2, 1), (0.5, 1)], "s double, y int")
    assert o.roc_auc(single, [], "s", "y").first().auc is None


def test_ks_statistic(spark):
    rng = np.random.default_rng(3)
    first, second = rng.random(120), rng.random(80) ** 2
    rows = [(float(s), False) for s in first] + [(float(s), True) for s in second]
    found = o.ks_statistic(spark.createDataFrame(rows, "s double, b boolean"), [], "s", "b").first()
    grid = np.concatenate([first, second])
    share = lambda x: np.searchsorted(np.sort(x), grid, side="right") / len(x)
    assert found.ks_statistic == pytest.approx(np.abs(share(first) - share(second)).max())
    assert (found.first_size, found.second_size) == (120, 80)


def test_ks_tail(spark):
    row = spark.range(1).select(
        o.ks_tail_probability(F.lit(0.3), F.lit(100), F.lit(100)).alias("small"),
        o.ks_tail_probability(F.lit(0.0), F.lit(100), F.lit(100)).alias("one"),
    )
    small, one = row.first()
    x2 = 0.09 * 50
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x2) for k in range(1, 101))
    assert small == pytest.approx(series)
    assert one == 1.0
