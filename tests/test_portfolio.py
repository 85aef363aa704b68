import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import portfolio as pf

SCHEMA = "run int, step int, asset int, weight double, current_price double, next_price double"


def _rows(runs=3, steps=30, assets=3, seed=2):
    r = random.Random(seed)
    out = []
    for run in range(runs):
        for step in range(steps):
            w = [r.uniform(0.1, 1) for _ in range(assets)]
            for a in range(assets):
                p = r.uniform(0.9, 1.1)
                out.append((run, step, a, w[a] / sum(w), p, p * r.uniform(0.98, 1.02)))
    return out


def _plain(rows):
    """Step returns by a plain loop, as {run: [(free, mu)]}."""
    table = {}
    for run, step, asset, w, p, n in rows:
        table.setdefault(run, {}).setdefault(step, {})[asset] = (w, p, n)
    out = {}
    for run, steps in table.items():
        held = None
        for step in sorted(steps):
            s = steps[step]
            free = 1 + sum(w * (n - p) for w, p, n in s.values())
            mu = 1.0
            if held is not None:
                mu = 1 - (sum(abs(s[a][0] - held[a]) for a in s if a > 0) * pf.COMMISSION + pf.DECAY)
            out.setdefault(run, []).append((free, mu))
            total = sum(n * w for w, p, n in s.values())
            held = {a: n * w / total for a, (w, p, n) in s.items()}
    return out


@pytest.mark.parametrize("page_rows", [None, 7])
def test_returns_and_summary(spark, page_rows):
    rows = _rows()
    want = _plain(rows)
    returns = pf.step_returns(spark.createDataFrame(rows, SCHEMA), page_rows=page_rows)
    got = {(r.run, r.step): (r.free_return, r.mu) for r in returns.collect()}
    for run, steps in want.items():
        for step, pair in enumerate(steps):
            assert got[run, step] == pytest.approx(pair, abs=1e-12)
    value = 1.0
    summary = {r.run: r for r in pf.run_summary(returns, page_rows=1 if page_rows else None).collect()}
    for run, steps in sorted(want.items()):
        rets = [f * m for f, m in steps]
        mean = sum(rets) / len(rets)
        std = math.sqrt(sum((x - mean) ** 2 for x in rets) / len(rets))
        value *= math.prod(rets)
        row = summary[run]
        assert row.value == pytest.approx(value)
        assert (row.mean, row.std, row.sharpe) == pytest.approx((mean, std, (mean - 1) / std))
        assert row.loss == pytest.approx(-sum(map(math.log, rets)) / len(rets))
        assert row.log_mean_free == pytest.approx(sum(f for f, _ in steps) / len(steps))


def test_single_asset_pays_only_decay(spark):
    mu = pf.turnover(spark.createDataFrame(_rows(1, 5, 1), SCHEMA)).orderBy("step").collect()
    assert [r.mu for r in mu] == [1.0] + [pytest.approx(1 - pf.DECAY, abs=1e-15)] * 4


def test_weights_salted_equals_window(spark):
    df = spark.createDataFrame(_rows(), SCHEMA).withColumn("weight", F.col("weight") * 3)
    a, b = (
        {(r.run, r.step, r.asset): r.weight for r in pf.normalise_weights(df, large=large).collect()} for large in (False, True)
    )
    assert a == pytest.approx(b)
    assert sum(v for k, v in a.items() if k[:2] == (0, 0)) == pytest.approx(1)


def test_signs_profit_and_delta(spark):
    df = spark.createDataFrame([(1, "long", 0.6, 2.0), (1, "short", 0.4, 2.0)], "step int, kind string, weight double, delta double")
    assert pf.profit(pf.signed_weights(df), ["step"]).first().pnl == pytest.approx(0.4)
    row = df.select(pf.portfolio_delta(F.array(F.lit(0.75), F.lit(0.25)), F.array(F.lit(0.5), F.lit(0.5))).alias("d")).first()
    assert row.d == [0.25, -0.25]
