import datetime as dt
import math

import pytest

from tablewright.operators import usage

SCHEMA = (
    "usage_metadata struct<job_id:string,job_run_id:string>, product_features struct<is_serverless:boolean>, "
    "record_type string, usage_start_time timestamp, usage_quantity double, sku_name string"
)


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def billing(spark, rows):
    return usage.flatten_billing(spark.createDataFrame(
        [((j, r), (s,), kind, at(m), q, "sku-s" if s else "sku-c") for j, r, s, m, q, kind in rows], SCHEMA))


ROWS = [
    ("j", "c1", False, 0, 1.0, "ORIGINAL"),
    ("j", "trial", True, 1, 9.0, "ORIGINAL"),
    ("j", "c2", False, 5, 1.0, "ORIGINAL"),
    ("j", "c3", False, 10, 0.5, "ORIGINAL"),
    ("j", "c3", False, 11, 0.5, "ORIGINAL"),
    ("j", "c9", False, 99, 7.0, "RETRACTION"),
    ("j", "s1", True, 11, 0.25, "ORIGINAL"),
    ("j", "s2", True, 15, 0.25, "ORIGINAL"),
    ("j", "s3", True, 20, 0.25, "ORIGINAL"),
    ("k", "only", False, 3, 2.0, "ORIGINAL"),
]


def test_windows_by_record_and_by_run(spark):
    rows = billing(spark, ROWS)
    record = usage.usage_windows(rows, 2, "j").collect()
    assert {(r.compute_type, r.run_id, r["rank"]) for r in record} == {
        ("classic", "c3", 1), ("classic", "c3", 2), ("serverless", "s1", 1), ("serverless", "s2", 2)}
    run = usage.usage_windows(rows, 2, "j", by="run").collect()
    assert {(r.compute_type, r.run_id, r["rank"]) for r in run} == {
        ("classic", "c3", 1), ("classic", "c2", 2), ("serverless", "s1", 1), ("serverless", "s2", 2)}
    with pytest.raises(ValueError):
        usage.usage_windows(rows, 2, by="day")


def test_compare_ratio_and_sizes(spark):
    rows = billing(spark, ROWS)
    windows = usage.usage_windows(rows, 3)
    got = {(r.job_id, r.compute_type): r for r in usage.usage_compare(rows, windows).collect()}
    classic = got["j", "Classic"]
    assert (classic.records, classic.runs, classic.total, classic.window_start) == (3, 2, 2.0, at(5))
    assert got["j", "Serverless"].total == 0.75
    ratios = {r.job_id: r.ratio for r in usage.usage_ratio(usage.usage_compare(rows, windows)).collect()}
    assert ratios["j"] == pytest.approx(2 / 0.75) and ratios["k"] == math.inf
    enough = {(r.job_id, r.compute_type): r.enough for r in usage.window_sizes(windows, 3).collect()}
    assert enough == {("j", "classic"): True, ("j", "serverless"): True, ("k", "classic"): False}
