import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import serving


def trace(tokens, spans):
    info = {"request_id": "t", "execution_time_ms": 41, "status": "OK"}
    if tokens:
        info["token_usage"] = dict(zip(("input_tokens", "output_tokens", "total_tokens"), tokens))
    return json.dumps({"info": info, "data": {"spans": spans}})


def chat(n_in, n_out):
    return {"name": "call", "attributes": {
        "mlflow.spanType": "\"CHAT_MODEL\"",
        "mlflow.chat.tokenUsage": json.dumps({"input_tokens": n_in, "output_tokens": n_out})}}


def test_trace_tokens(spark):
    agent = {"name": "agent", "attributes": {"mlflow.spanType": "\"AGENT\""}}
    bare = {"name": "bare", "attributes": {}}
    rows = [
        (1, trace((1500, 100, 1600), [agent, chat(600, 30)])),
        (2, trace(None, [agent, chat(600, 30), bare, chat(900, 70)])),
        (3, trace(None, [agent])),
        (4, trace(None, None)),
        (5, trace(None, [chat(0, 7)])),
        (7, json.dumps({"info": {"request_id": "t", "token_usage": {}}, "data": {"spans": [chat(1, 2)]}})),
        (8, "no json"), (9, None), (10, "[1]"), (11, json.dumps({"data": {"spans": [chat(5, 6), {"name": "y"}, chat(1, 1)]}})),
        (6, trace(None, [{"name": "x", "attributes": {"mlflow.spanType": "\"CHAT_MODEL\""}}, chat(3, 4)])),
    ]
    got = {r.id: (r.input_tokens, r.output_tokens) for r in
           serving.trace_tokens(spark.createDataFrame(rows, "id int, trace string")).collect()}
    assert got == {1: (1500, 100), 2: (1500, 100), 3: (None, None), 4: (None, None), 5: (None, None), 6: (3, 4), 7: (1, 2),
                   8: (None, None), 9: (None, None), 10: (None, None), 11: (6, 7)}


def test_turn_profile_with_a_long_conversation(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for conv, length in (("long", 200), ("short", 3)):
        said = 0
        for turn in range(length):
            words = rng.randint(0, 6)
            role = "assistant" if turn % 2 else "user"
            rows.append((conv, turn, role, "  ".join(["w"] * words) + " \n"))
            if role == "assistant":
                want[conv, turn] = (said, words)
            said += words
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string").repartition(4)
    got = serving.turn_profile(df, block=16).collect()
    assert {(r.conv_id, r.turn): (r.input_tokens, r.output_tokens) for r in got} == want


def test_latency_metrics(spark):
    rows = [("a", 0, 100), ("a", 0, 160), ("a", 0, 300), ("one", 5, 25), ("none", 5, None)]
    df = spark.createDataFrame(rows, "request_id string, start bigint, token_ts bigint")
    got = {r.request_id: tuple(r)[1:] for r in serving.latency_metrics(df).collect()}
    assert got == {"a": (3, 100, 100.0, 300), "one": (1, 20, 0.0, 20), "none": (0, None, None, None)}


def test_profile_summary(spark):
    df = spark.createDataFrame([(i, float(i) if i % 2 else None) for i in range(1, 11)], "a int, b double")
    got = {r.metric: tuple(r)[1:] for r in serving.profile_summary(df, ["a", "b"]).collect()}
    assert got == {"a": (10, 5.5, 6.0, 8.0, 10.0, 10.0), "b": (5, 5.0, 5.0, 7.0, 9.0, 9.0)}


def limits(spark):
    rows = [("open", 90_000, 6_000, None), ("slow", 90_000, 6_000, 420), ("narrow", 800, 6_000, 9_000), ("tied", 1_000, 1_000, 300)]
    return spark.createDataFrame(rows, "model string, itpm bigint, otpm bigint, qph bigint")


def test_capacity_ceiling(spark):
    requests = spark.createDataFrame([(100, 300), (300, 100)], "input_tokens bigint, output_tokens bigint")
    got = {r.model: (r.binding, r.max_qpm) for r in serving.capacity_ceiling(requests, limits(spark)).collect()}
    assert got == {"open": ("OTPM", 30.0), "slow": ("QPH", 7.0), "narrow": ("ITPM", 4.0), "tied": ("ITPM", 5.0)}


def test_frontiers(spark):
    df = spark.createDataFrame([(2000, 200), (200, 2000), (1, 10**6)], "input_tokens bigint, output_tokens bigint")
    for r in serving.with_frontiers(df).collect():
        n_in, n_out = r.input_tokens, r.output_tokens
        assert r.qpm_1x == pytest.approx(1 / (n_in / 400_000 + n_out / 100_000))
        assert r.qpm_2x == pytest.approx(2 * r.qpm_1x)
        x, y = r.qpm_combined * n_in, r.qpm_combined * n_out
        edge = 210_000 - x / 20 if x <= 200_000 else 200_000 - (x - 200_000) / 4
        assert y == pytest.approx(edge)


def test_spans_and_fallbacks(spark):
    spans = spark.createDataFrame([("p", 10.0, "OK"), ("p", 2.5, "ERROR"), ("q", 1.0, "OK")],
                                  "parent_id string, duration double, status string")
    assert {tuple(r) for r in serving.span_latency(spans).collect()} == {("p", 2, 10.0, 12.5, 1), ("q", 1, 1.0, 1.0, 0)}
    start = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(start + dt.timedelta(minutes=m), s) for m, s in ((0, 429), (1, 200), (59, 503), (61, 400))],
                                "ts timestamp, status_code int")
    got = serving.fallback_rate(log).orderBy("bucket").collect()
    assert [(r.requests, r.fallbacks) for r in got] == [(3, 2), (1, 0)]


def test_demand_and_tier(spark):
    log = spark.range(40).select(
        F.timestamp_seconds(F.floor(F.sqrt("id")) * 60).alias("ts"), F.lit(1000).alias("input_tokens"),
        F.lit(3000).alias("output_tokens"))
    got = {r.percent: r for r in serving.demand(log).collect()}
    assert (got[75].qpm, got[75].itpm) == (9.0, 9000.0) and got[90].qpm == 11.0
    tiers = serving.tier_needed(serving.demand(log), serving.capacity_ceiling(log, limits(spark).replace(6_000, 31_000, "otpm")))
    found = {(r.model, r.percent): r.tier for r in tiers.collect()}
    assert len(found) == 8 and found["open", 75] == "pay-per-token" and found["open", 90] == "provisioned"
    assert found["tied", 75] == "provisioned"
