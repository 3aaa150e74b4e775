import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import resample


def _at(text):
    return dt.datetime.fromisoformat(text)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, v double, w double")


ROWS = [
    ("a", _at("2024-01-01 00:00:00"), 1.0, None), ("a", _at("2024-01-01 00:09:59.999999"), 3.0, float("nan")),
    ("a", _at("2024-01-01 00:10:00"), 5.0, 2.0), ("a", _at("2024-01-01 00:45:00"), None, 4.0),
    ("a", _at("2024-01-02 03:01:00"), 7.0, 8.0), ("b", _at("2023-12-31 23:59:00"), 1.0, 1.0),
    (None, _at("2024-01-01 12:00:00"), 2.0, 2.0), (None, _at("2024-01-01 12:31:00"), 4.0, 2.0),
    ("c", None, 4.0, 4.0),
]


def _pandas(rows, period):
    """Mean per bin of one series on a gapless grid, bins counted from the first midnight."""
    frame = pd.DataFrame([row for row in rows if row[1] is not None], columns=["s", "ts", "v", "w"])
    result = frame.set_index("ts")[["v", "w"]].astype(float).resample(period).mean()
    return {
        ts.to_pydatetime(): tuple(None if math.isnan(x) else round(float(x), 9) for x in values)
        for ts, values in zip(result.index, result.to_numpy())}


def _means(rows):
    return {row.ts: tuple(None if x is None else round(x, 9) for x in (row.v, row.w)) for row in rows}


@pytest.mark.parametrize("period", ["10min", "60min", "7min", "25min", "1min"])
def test_grid_per_series_equals_pandas(spark, period):
    found = resample.resample_grid(_frame(spark, ROWS), "ts", ["v", "w"], period, ["series"]).collect()
    for series in ("a", "b", None):
        wanted = _pandas([row for row in ROWS if row[0] == series], period)
        got = _means(row for row in found if row.series == series)
        assert got == wanted
    assert {row.series for row in found} == {"a", "b", None}


@pytest.mark.parametrize("period", ["10min", "7min"])
def test_grid_of_a_whole_frame_equals_pandas(spark, period):
    found = resample.resample_grid(_frame(spark, ROWS), "ts", ["v", "w"], period).collect()
    wanted = _pandas(ROWS, period)
    assert _means(found) == wanted
    assert len(found) == len(wanted)


def test_bin_of_empty_values_is_null(spark):
    rows = resample.resample_mean(_frame(spark, ROWS), "ts", ["v", "w"], "10min", ["series"])
    empty = rows.filter((F.col("series") == "a") & (F.col("ts") == F.lit(_at("2024-01-01 00:40:00")))).first()
    assert empty.v is None and empty.w == 4.0


def test_long_gap_spans_many_chunks(spark):
    rows = [("a", _at("2023-01-01 00:00:00"), 1.0, 1.0), ("a", _at("2024-01-01 00:00:00"), 2.0, 1.0)]
    grid = resample.resample_grid(_frame(spark, rows), "ts", ["v"], "10min", ["series"])
    assert grid.count() == 365 * 144 + 1
    assert grid.select("ts").distinct().count() == 365 * 144 + 1


def test_grid_of_a_resampled_table(spark):
    means = resample.resample_mean(_frame(spark, ROWS), "ts", ["v"], "10min", ["series"])
    direct = resample.resample_grid(_frame(spark, ROWS), "ts", ["v"], "10min", ["series"])
    filled = resample.gapless_grid(means, "ts", "10min", ["series"])
    assert sorted(map(str, filled.collect())) == sorted(map(str, direct.collect()))


def test_input_is_read_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    _frame(spark, ROWS).write.parquet(path)
    grid = resample.resample_grid(spark.read.parquet(path), "ts", ["v"], "10min", ["series"])
    grid.collect()
    plan = grid._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_period_must_be_positive(spark):
    with pytest.raises(ValueError):
        resample.resample_mean(_frame(spark, ROWS), "ts", ["v"], 0)
