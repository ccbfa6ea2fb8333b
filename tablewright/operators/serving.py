"""Request profiles, traces, rates and capacity of a model-serving workload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import word_count
from tablewright.operators.ordered import index_percentiles, running_by_bucket

# fixed values: provisioned tokens per minute in and out, and the pay-per-token ceiling
PROVISIONED = {"1x": (400_000, 100_000), "2x": (800_000, 200_000)}
PAY_PER_TOKEN = (200_000, 10_000)
FALLBACK_CODES = (429, 503)

TOKENS = "struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>"
SPANS = "array<struct<attributes:map<string,string>>>"
# fixed values: attribute names of the trace format
SPAN_TYPE, SPAN_TOKENS, CHAT = "mlflow.spanType", "mlflow.chat.tokenUsage", "CHAT_MODEL"
PLAIN_TOKENS = "llm.token_usage.input_tokens"


def turn_profile(messages: DataFrame, block: int = 4096) -> DataFrame:
    """Tokens of each answer and of all that was said before it, per conversation and turn.

    ``messages`` holds conv_id, turn, role and text; a token is a word. Long
    conversations are summed by blocks of turns. A null turn comes before all others.
    """
    counted = messages.select("conv_id", "turn", "role", word_count("text").alias("tokens"))
    running = running_by_bucket(
        counted, ["conv_id"], ["turn"], F.coalesce(F.floor(F.col("turn") / block), F.lit(-1)), sums={"upto": "tokens"}
    )
    return running.where(F.col("role") == "assistant").select(
        "conv_id", "turn", (F.col("upto") - F.col("tokens")).alias("input_tokens"),
        F.col("tokens").alias("output_tokens"),
    )


def latency_metrics(tokens: DataFrame) -> DataFrame:
    """Time to first token, time per further token and total, from ``(request_id, start, token_ts)``.

    Times are in milliseconds. Requests without a token time have nulls; one token
    or none gives 0 per further token.
    """
    per_request = tokens.groupBy("request_id").agg(
        F.min("start").alias("start"), F.min("token_ts").alias("first"),
        F.max("token_ts").alias("last"), F.count("token_ts").alias("output_tokens"),
    )
    ttft, total = F.col("first") - F.col("start"), F.col("last") - F.col("start")
    tpot = F.when(F.col("output_tokens") > 1, (total - ttft) / (F.col("output_tokens") - 1)).otherwise(0.0)
    return per_request.select(
        "request_id", "output_tokens",
        F.round(ttft, 2).alias("ttft_ms"),
        F.when(F.col("first").isNotNull(), F.round(tpot, 2)).alias("tpot_ms"),
        F.round(total, 2).alias("total_ms"),
    )


def trace_tokens(traces: DataFrame, column: str = "trace") -> DataFrame:
    """Input and output tokens of each trace document.

    The trace's own total is used where there is one, else the sum over its chat
    spans, whose attributes hold JSON texts. Without input tokens both are null, as for a text that is no JSON.
    Each document is parsed once, as a variant, and its spans are gone through once.
    """
    rest = [c for c in traces.columns if c != column]
    spans = F.try_variant_get("v", "$.data.spans", SPANS)
    attributes = F.transform(F.coalesce(spans, F.array().cast(SPANS)), lambda s: s["attributes"])
    chats = F.filter(attributes, lambda a: F.trim(F.try_element_at(a, F.lit(SPAN_TYPE))).isin(CHAT, f'"{CHAT}"'))

    def tokens(a: Column) -> Column:
        text = F.coalesce(F.try_element_at(a, F.lit(SPAN_TOKENS)), F.try_element_at(a, F.lit(PLAIN_TOKENS)))
        return F.from_json(text, TOKENS)

    fields = ("input_tokens", "output_tokens")
    none = F.struct(*(F.lit(0).cast("long").alias(f) for f in fields))
    summed = F.aggregate(
        F.transform(chats, tokens), none,
        lambda acc, t: F.struct(*((acc[f] + F.coalesce(t[f], F.lit(0).cast("long"))).alias(f) for f in fields)),
    )
    parsed = traces.select(*rest, F.try_parse_json(column).alias("v")).select(
        *rest, F.try_variant_get("v", "$.info.request_id", "string").alias("request_id"),
        F.try_variant_get("v", "$.info.execution_time_ms", "bigint").alias("total_ms"),
        *(F.try_variant_get("v", f"$.info.token_usage.{f}", "bigint").alias(f"own_{f}") for f in fields),
        summed.alias("s"),
    )

    def pick(field: str) -> Column:
        return (
            F.when(F.col("own_input_tokens").isNotNull(), F.col(f"own_{field}"))
            .when(F.col("s.input_tokens") > 0, F.col(f"s.{field}"))
            .alias(field)
        )

    return parsed.select(*rest, "request_id", *(pick(f) for f in fields), "total_ms")


def profile_summary(requests: DataFrame, metrics: Sequence[str], percents: Sequence[int] = (50, 75, 95)) -> DataFrame:
    """Mean, percentiles and maximum of each metric, nulls ignored, rounded to 2 places."""
    rows = index_percentiles(requests, metrics, percents)

    def at(p: int) -> Column:
        return F.round(F.max(F.when(F.col("percent") == p, F.col("value"))), 2).alias(f"p{p}")

    return rows.groupBy("metric").agg(
        F.first("n").alias("n"), F.round(F.first("avg"), 2).alias("avg"),
        *[at(p) for p in percents], F.round(F.first("max"), 2).alias("max"),
    )


def span_latency(spans: DataFrame) -> DataFrame:
    """Per parent: spans, longest (the wait of a parallel fan-out), summed time and errors."""
    return spans.groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("spans"), F.max("duration").alias("critical_path"),
        F.sum(F.col("duration").cast("decimal(28,6)")).cast("double").alias("total"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
    )


def fallback_rate(requests: DataFrame, width: str = "1 hour", codes: Sequence[int] = FALLBACK_CODES) -> DataFrame:
    """Share of requests per time bucket whose status sends them to the fallback tier."""
    fell = F.col("status_code").isin(*codes)
    return requests.groupBy(F.window(F.col("ts").cast("timestamp"), width)["start"].alias("bucket")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(fell).alias("fallbacks"),
        F.avg(fell.cast("double")).alias("fallback_rate"),
    )


def usage_per_minute(requests: DataFrame, width: str = "1 minute") -> DataFrame:
    """Requests, tokens and error rate per minute; on a stream, set a watermark on ``ts`` first."""
    return requests.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.avg((F.col("status_code") >= 400).cast("double")).alias("error_rate"),
    ).select(F.col("w.start").alias("minute"), "requests", "input_tokens", "output_tokens", "error_rate")


def demand(requests: DataFrame, percents: Sequence[int] = (75, 90)) -> DataFrame:
    """Percentiles of the queries per minute, and the token rates they come to."""
    ts = F.col("ts").cast("timestamp")
    minutes = requests.groupBy(F.window(ts, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("qpm"))
    shape = requests.agg(F.avg("input_tokens").alias("avg_in"), F.avg("output_tokens").alias("avg_out"))
    rates = index_percentiles(minutes.select("qpm"), ["qpm"], percents)
    return rates.select(
        "percent", F.col("value").alias("qpm"),
        (F.col("value") * shape.select("avg_in").scalar()).alias("itpm"),
        (F.col("value") * shape.select("avg_out").scalar()).alias("otpm"),
    )


def capacity_ceiling(requests: DataFrame, limits: DataFrame) -> DataFrame:
    """Highest queries per minute each model can serve, and the limit that binds.

    ``limits`` has model, itpm and otpm (tokens per minute in and out) and qph (queries per hour, null if unlimited).
    Earlier limits win ties, in the order input, output, queries.
    """
    shape = requests.agg(F.avg("input_tokens").alias("avg_in"), F.avg("output_tokens").alias("avg_out"))
    rows = limits.select(
        "model",
        (F.col("itpm") / shape.select("avg_in").scalar()).alias("by_input"),
        (F.col("otpm") / shape.select("avg_out").scalar()).alias("by_output"),
        (F.col("qph") / 60).alias("by_queries"),
    )
    best = F.least("by_input", "by_output", "by_queries")
    return rows.select(
        "model", "by_input", "by_output", "by_queries",
        F.when(F.col("by_input") == best, "ITPM").when(F.col("by_output") == best, "OTPM").otherwise("QPH")
        .alias("binding"),
        best.alias("max_qpm"),
    )


def frontier_qpm(n_in: Column, n_out: Column, itpm: float, otpm: float) -> Column:
    """Queries per minute on the straight line between the two token limits."""
    return F.try_divide(F.lit(1.0), n_in / itpm + n_out / otpm)


def combined_qpm(
    n_in: Column, n_out: Column, provisioned: tuple[float, float], overflow: tuple[float, float]
) -> Column:
    """Queries per minute with an overflow tier on top of provisioned capacity.

    What both tiers bear together is bounded by one line for each tier: its own
    trade of input for output, with all that the other tier adds. Capacity is the
    smaller of the two; requests without tokens have none.
    """
    tiers = (provisioned, overflow)
    bounds = []
    for own_in, own_out in tiers:
        trade = own_out / own_in  # output tokens given up for an input token
        budget = max(trade * i + o for i, o in corners(*tiers))
        bounds.append(F.try_divide(F.lit(float(budget)), n_out + trade * n_in))
    return F.least(*bounds)


def corners(a: tuple[float, float], b: tuple[float, float]) -> list[tuple[float, float]]:
    """The corners of two tiers' joint frontier: each tier spends all on input or all on output."""
    return [(i * a[0] + j * b[0], (1 - i) * a[1] + (1 - j) * b[1]) for i in (0, 1) for j in (0, 1)]


def with_frontiers(requests: DataFrame) -> DataFrame:
    """Add the queries per minute of each capacity tier for a request's token counts."""
    n_in, n_out = F.col("input_tokens").cast("double"), F.col("output_tokens").cast("double")
    return requests.select(
        "*",
        *[frontier_qpm(n_in, n_out, *PROVISIONED[t]).alias(f"qpm_{t}") for t in PROVISIONED],
        combined_qpm(n_in, n_out, PROVISIONED["2x"], PAY_PER_TOKEN).alias("qpm_combined"),
    )


def tier_needed(demand_rows: DataFrame, ceiling: DataFrame) -> DataFrame:
    """For each model and demand percentile, whether pay-per-token is enough."""
    # one entry per percentile
    wanted = demand_rows.agg(F.collect_list(F.struct("percent", "qpm")).alias("d")).scalar()
    return ceiling.select("model", "max_qpm", F.explode(wanted).alias("d")).select(
        "model", "d.percent", "d.qpm", "max_qpm",
        F.when(F.col("d.qpm") < F.col("max_qpm"), "pay-per-token").otherwise("provisioned").alias("tier"),
    )
