from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from tillmark.operators import forecast as fc


@pytest.fixture
def history():
    random.seed(3)
    return {name: [random.randint(0, 40) + trend * i for i in range(n)]
            for name, n, trend in (("long", 50, 0), ("short", 14, 1), ("falling", 35, -3), ("few", 13, 0))}


@pytest.fixture
def series(spark, history):
    start = dt.date(2023, 1, 1)
    return spark.createDataFrame([(k, start + dt.timedelta(days=2 * i), v) for k, vs in history.items() for i, v in enumerate(vs)],
                                 "product_id string, day date, y bigint")


def expected(values, horizon):
    tail = np.array(values[-30:], dtype=float)
    slope, intercept = np.polyfit(np.arange(len(tail)), tail, 1)
    ma = np.full(horizon, np.mean(values[-7:]))
    linear = np.maximum(slope * np.arange(len(tail), len(tail) + horizon) + intercept, 0)
    seasonal = np.maximum(np.tile(values[-7:], horizon // 7 + 1)[:horizon], 0)
    return ma, linear, seasonal


@pytest.mark.parametrize("horizon", [7, 10, 45])
def test_models_match_numpy(series, history, horizon):
    got = fc.ensemble(series, horizon=horizon).orderBy("product_id", "step").collect()
    assert {r["product_id"] for r in got} == {"long", "short", "falling"}
    for name in ("long", "short", "falling"):
        rows = [r for r in got if r["product_id"] == name]
        ma, linear, seasonal = expected(history[name], horizon)
        mean, std = (ma + linear + seasonal) / 3, np.std([ma, linear, seasonal], axis=0, ddof=1)
        for column, want in {"ma": ma, "linear": linear, "seasonal": seasonal, "forecast": mean,
                             "lower_80": np.maximum(mean - 1.28 * std, 0), "upper_95": mean + 1.96 * std}.items():
            assert [r[column] for r in rows] == pytest.approx(list(want), abs=1e-9)
        last = dt.date(2023, 1, 1) + dt.timedelta(days=2 * (len(history[name]) - 1))
        assert rows[0]["forecast_date"] == last + dt.timedelta(days=1)


def test_summary_compares_with_history(series, history):
    summary = {r["product_id"]: r for r in fc.forecast_summary(fc.ensemble(series, horizon=7)).collect()}
    mean = np.mean(sum(expected(history["long"], 7)) / 3)
    old = np.mean(history["long"][-7:])
    assert summary["long"]["total_forecast"] == pytest.approx(7 * mean, abs=1e-4)
    assert summary["long"]["pct_change"] == pytest.approx((mean - old) / max(old, 1) * 100, abs=1e-4)
