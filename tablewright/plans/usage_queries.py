"""Queries over events and conversations: billing windows, request profiles, capacity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import serving, usage
from tablewright.operators.evaluate import relative_throughput
from tablewright.operators.ordered import index_percentiles
from tablewright.plans import roles
from tablewright.plans.registry import query
from tablewright.session import scratch_path
from tablewright.sources.tables import short_classes
from tablewright.streaming.requests import stream_usage, write_usage
from tablewright.streaming.sync import read_file_stream

RUNS = 12
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

BILLED = f"""billed AS (
  SELECT user_id AS job_id, user_id::VARCHAR || '-' || strftime(ts, '%Y%m%d%H') AS run_id,
    ts >= TIMESTAMP '{roles.SERVERLESS_FROM}' OR event_type = 'signup' AS is_serverless,
    'JOBS_' || upper(event_type) AS sku_name, value AS quantity, ts
  FROM events WHERE event_type <> 'error'),
cutoff AS (SELECT job_id, max(ts) AS t FROM billed WHERE NOT is_serverless GROUP BY 1),
windows AS (
  SELECT 'classic' AS compute_type, job_id, run_id, ts, row_number() OVER
    (PARTITION BY job_id ORDER BY ts DESC, run_id DESC) AS rank FROM billed WHERE NOT is_serverless
  UNION ALL
  SELECT 'serverless', b.job_id, run_id, ts, row_number() OVER (PARTITION BY b.job_id ORDER BY ts, run_id)
  FROM billed b JOIN cutoff c ON c.job_id = b.job_id WHERE is_serverless AND ts >= c.t),
chosen AS (SELECT * FROM windows WHERE rank <= {RUNS}),
compared AS (
  SELECT job_id, CASE WHEN is_serverless THEN 'Serverless' ELSE 'Classic' END AS compute_type, sku_name,
    count(*) AS records, count(DISTINCT run_id) AS runs,
    sum(CAST(quantity AS DECIMAL(28, 6)))::DOUBLE AS total, min(ts) AS window_start, max(ts) AS window_end
  FROM billed b WHERE EXISTS (SELECT 1 FROM chosen c WHERE c.job_id = b.job_id AND c.run_id = b.run_id)
  GROUP BY 1, 2, 3)"""


def usage_and_windows(spark, sf, by="record"):
    rows = usage.flatten_billing(roles.billing(spark, sf))
    return rows, usage.usage_windows(rows, RUNS, by=by)


@query("usage_windows", f"""WITH {BILLED}
SELECT compute_type, job_id, run_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start, rank::INTEGER AS rank FROM chosen""")
def _(spark, sf):
    _, windows = usage_and_windows(spark, sf)
    return windows.select(
        "compute_type", "job_id", "run_id", F.date_format("usage_start_time", STAMP).alias("start"), "rank"
    )


@query("usage_windows_by_run", f"""WITH {BILLED},
firsts AS (SELECT compute_type, job_id, run_id, min(ts) AS ts FROM windows GROUP BY 1, 2, 3)
SELECT * FROM (SELECT compute_type, job_id, run_id, row_number() OVER (PARTITION BY compute_type, job_id ORDER BY
  CASE WHEN compute_type = 'classic' THEN -epoch_us(ts) ELSE epoch_us(ts) END,
  CASE WHEN compute_type = 'classic' THEN NULL ELSE run_id END)::INTEGER AS rank FROM firsts) WHERE rank <= {RUNS}""")
def _(spark, sf):
    _, windows = usage_and_windows(spark, sf, "run")
    return windows.select("compute_type", "job_id", "run_id", "rank")


@query("usage_window_sizes", f"""WITH {BILLED}
SELECT job_id, compute_type, count(*) AS found, count(*) >= {RUNS} AS enough FROM chosen GROUP BY 1, 2""")
def _(spark, sf):
    return usage.window_sizes(usage_and_windows(spark, sf)[1], RUNS)


@query("usage_compare", f"""WITH {BILLED}
SELECT job_id, compute_type, sku_name, records, runs, total,
  strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S.%f') AS window_end FROM compared""")
def _(spark, sf):
    compared = usage.usage_compare(*usage_and_windows(spark, sf))
    return compared.withColumns({c: F.date_format(c, STAMP) for c in ("window_start", "window_end")})


@query("usage_ratio", f"""WITH {BILLED}, t AS (
  SELECT job_id, round(sum(total) FILTER (compute_type = 'Classic'), 6) AS classic,
    round(sum(total) FILTER (compute_type = 'Serverless'), 6) AS serverless FROM compared GROUP BY 1)
SELECT job_id, coalesce(classic, 0) AS classic, coalesce(serverless, 0) AS serverless,
  CASE WHEN coalesce(serverless, 0) = 0 THEN 'infinity'::DOUBLE ELSE round(coalesce(classic, 0) / serverless, 6) END AS ratio FROM t""")
def _(spark, sf):
    ratios = usage.usage_ratio(usage.usage_compare(*usage_and_windows(spark, sf)))
    return ratios.select("job_id", *[F.round(c, 6).alias(c) for c in ("classic", "serverless")],
                         F.when(F.col("ratio") == float("inf"), F.col("ratio")).otherwise(F.round("ratio", 6)).alias("ratio"))


@query("short_classes", """SELECT c AS class, count(event_id) AS found FROM
  (VALUES ('signup'), ('purchase'), ('error'), ('view'), ('click'), ('refund')) v(c)
  LEFT JOIN events ON event_type = c GROUP BY 1 HAVING count(event_id) < (SELECT count(*) / 5 FROM events)""")
def _(spark, sf):
    events = roles.table(spark, sf, "events")
    kinds = ["signup", "purchase", "error", "view", "click", "refund"]
    least = events.agg((F.count(F.lit(1)) / 5)).scalar()
    return short_classes(events, "event_type", kinds, least)


@query("percentile_idx", """WITH s AS (SELECT value AS v, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events),
p AS (SELECT unnest([1, 50, 75, 90, 95, 99, 100]) AS percent)
SELECT percent, n, v AS value FROM s JOIN p ON i = least(floor(n * percent / 100)::BIGINT, n - 1)""")
def _(spark, sf):
    found = index_percentiles(roles.table(spark, sf, "events"), ["value"], [1, 50, 75, 90, 95, 99, 100])
    return found.select("percent", "n", "value")


WORDS = r"""words AS (SELECT conv_id, turn, role, CASE WHEN trim(regexp_replace(text, '^\s+|\s+$', '', 'g')) = '' THEN 0
  ELSE len(regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')) END AS tokens FROM conversations),
turns AS (SELECT conv_id, turn, role, tokens,
  sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn) - tokens AS before FROM words),
profile AS (SELECT conv_id, turn, before::BIGINT AS input_tokens, tokens::BIGINT AS output_tokens FROM turns
  WHERE role = 'assistant')"""


@query("turn_profile", f"WITH {WORDS} SELECT * FROM profile")
def _(spark, sf):
    return roles.turns(spark, sf)


@query("turn_profile_null_keys", f"WITH {WORDS.replace('FROM conversations', 'FROM (SELECT * REPLACE (nullif(conv_id % 50, 0) AS conv_id) FROM conversations)').replace('BY turn)', 'BY turn NULLS FIRST RANGE UNBOUNDED PRECEDING)')} SELECT conv_id, count(*) AS answers FROM profile GROUP BY 1")
def _(spark, sf):
    key = F.col("conv_id") % 50
    rows = roles.table(spark, sf, "conversations").withColumn("conv_id", F.when(key != 0, key))
    return serving.turn_profile(rows).groupBy("conv_id").agg(F.count("*").alias("answers"))


SUMMARY = """SELECT {name} AS metric, max(n) AS n, round(avg(v), 2) AS avg,
  round(max(CASE WHEN i = least(floor(n * 50 / 100)::BIGINT, n - 1) THEN v END), 2) AS p50,
  round(max(CASE WHEN i = least(floor(n * 75 / 100)::BIGINT, n - 1) THEN v END), 2) AS p75,
  round(max(CASE WHEN i = least(floor(n * 95 / 100)::BIGINT, n - 1) THEN v END), 2) AS p95,
  round(max(v), 2) AS max FROM (SELECT {v}::DOUBLE AS v, row_number() OVER (ORDER BY {v}) - 1 AS i,
    count(*) OVER () AS n FROM {src} WHERE {v} IS NOT NULL)"""


@query("profile_summary", "WITH " + WORDS + " " + " UNION ALL ".join(
    SUMMARY.format(name=f"'{c}'", v=c, src="profile") for c in ("input_tokens", "output_tokens")))
def _(spark, sf):
    return serving.profile_summary(roles.turns(spark, sf), ["input_tokens", "output_tokens"])


LATENCIES = """latencies AS (SELECT request_id, output_tokens, round(first - start, 2) AS ttft_ms,
  CASE WHEN first IS NOT NULL THEN round(CASE WHEN output_tokens > 1
    THEN (last - first)::DOUBLE / (output_tokens - 1) ELSE 0 END, 2) END AS tpot_ms, round(last - start, 2) AS total_ms
  FROM (SELECT user_id::VARCHAR || '-' || strftime(ts, '%Y%m%d') AS request_id, epoch_ms(date_trunc('day', min(ts))) AS start,
    min(epoch_us(ts) // 1000) FILTER (event_type <> 'signup') AS first, max(epoch_us(ts) // 1000) FILTER (event_type <> 'signup') AS last,
    count(*) FILTER (event_type <> 'signup') AS output_tokens FROM events GROUP BY 1))"""


def latencies(spark, sf):
    """Each user's day as a request whose tokens are its events; signups carry no token."""
    at = F.col("ts").cast("timestamp")
    return serving.latency_metrics(
        roles.table(spark, sf, "events").select(
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("request_id"),
            F.unix_millis(F.to_date("ts").cast("timestamp")).alias("start"),
            F.when(F.col("event_type") != "signup", F.unix_millis(at)).alias("token_ts"),
        )
    )


@query("latency_metrics", f"""WITH {LATENCIES} SELECT request_id, output_tokens, ttft_ms::BIGINT AS ttft_ms, tpot_ms,
  total_ms::BIGINT AS total_ms FROM latencies""")
def _(spark, sf):
    return latencies(spark, sf)


@query("latency_summary", f"WITH {LATENCIES} " + " UNION ALL ".join(
    SUMMARY.format(name=f"'{c}'", v=c, src="latencies") for c in ("ttft_ms", "tpot_ms", "total_ms")))
def _(spark, sf):
    return serving.profile_summary(latencies(spark, sf), ["ttft_ms", "tpot_ms", "total_ms"])


SPAN_KINDS = ("TOOL", "CHAT_MODEL", "RETRIEVER", "PARSER")


def trace_documents(spark, sf):
    """A trace per event. The event's number gives how many spans it has and the kind of each; some have totals."""
    k, value = F.get_json_object("props", "$.k").cast("bigint"), F.floor("value").cast("bigint")

    def counts(n_in, n_out):
        return F.struct(n_in.alias("input_tokens"), n_out.alias("output_tokens"))

    def span(i):
        kind = F.element_at(F.array(*map(F.lit, SPAN_KINDS)), ((k * 3 + i) % len(SPAN_KINDS) + 1).cast("int"))
        tokens = F.when(kind == "CHAT_MODEL", F.to_json(counts(k + i, value + i)))
        attributes = F.map_from_arrays(
            F.array(F.lit(serving.SPAN_TYPE), F.lit(serving.SPAN_TOKENS)), F.array(F.concat(F.lit('"'), kind, F.lit('"')), tokens)
        )
        return F.struct(F.concat_ws("-", F.lower(kind), i.cast("string")).alias("name"), attributes.alias("attributes"))

    info = F.struct(
        F.concat(F.lit("trace-"), F.col("event_id").cast("string")).alias("request_id"), value.alias("execution_time_ms"),
        F.when(F.col("event_type").isin("purchase", "view"), counts(k * 7, value * 2)).alias("token_usage"),
    )
    spans = F.transform(F.sequence(F.lit(0).cast("bigint"), k % 5), span)
    return roles.table(spark, sf, "events").select(
        "event_id", F.to_json(F.struct(info.alias("info"), F.struct(spans.alias("spans")).alias("data"))).alias("trace")
    )


@query("trace_tokens", """WITH e AS (SELECT event_id, event_type, (props::JSON ->> '$.k')::BIGINT AS k, floor(value)::BIGINT AS out FROM events),
spans AS (SELECT event_id, sum(k + i)::BIGINT AS n_in, sum(out + i)::BIGINT AS n_out
  FROM (SELECT *, unnest(range(0, k % 5 + 1)) AS i FROM e) WHERE (k * 3 + i) % 4 = 1 GROUP BY 1)
SELECT e.event_id, 'trace-' || e.event_id AS request_id,
  CASE WHEN event_type IN ('purchase', 'view') THEN k * 7 WHEN n_in > 0 THEN n_in END AS input_tokens,
  CASE WHEN event_type IN ('purchase', 'view') THEN out * 2 WHEN n_in > 0 THEN n_out END AS output_tokens,
  out AS total_ms FROM e LEFT JOIN spans USING (event_id)""")
def _(spark, sf):
    return serving.trace_tokens(trace_documents(spark, sf))


@query("span_latency", """SELECT user_id AS parent_id, count(*) AS spans, max(value) AS critical_path,
  sum(value::DECIMAL(28, 6))::DOUBLE AS total, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1""")
def _(spark, sf):
    return serving.span_latency(
        roles.table(spark, sf, "events").select(
            F.col("user_id").alias("parent_id"), F.col("value").alias("duration"),
            F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"),
        )
    )


LOG = """log AS (SELECT ts, k * 20 AS input_tokens, floor(value)::BIGINT AS output_tokens,
  CASE k % 10 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 400 ELSE 200 END AS status_code
  FROM (SELECT *, (props::JSON ->> '$.k')::BIGINT AS k FROM events))"""


@query("fallback_rate", f"""WITH {LOG} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS bucket,
  count(*) AS requests, count(*) FILTER (status_code IN (429, 503)) AS fallbacks,
  round(avg((status_code IN (429, 503))::INT), 6) AS fallback_rate FROM log GROUP BY 1""")
def _(spark, sf):
    rates = serving.fallback_rate(roles.requests(spark, sf))
    return rates.select(F.date_format("bucket", "yyyy-MM-dd HH:mm").alias("bucket"), "requests", "fallbacks",
                        F.round("fallback_rate", 6).alias("fallback_rate"))


MINUTES = """minutes AS (SELECT date_trunc('minute', ts) AS m, count(*) AS requests, sum(input_tokens)::BIGINT AS input_tokens,
  sum(output_tokens)::BIGINT AS output_tokens, round(avg((status_code >= 400)::INT), 6) AS error_rate FROM log GROUP BY 1)"""
MINUTE_ROW = "SELECT strftime(m, '%Y-%m-%d %H:%M') AS minute, requests, input_tokens, output_tokens, error_rate FROM minutes"


def minute_rows(minutes):
    return minutes.select(
        F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "requests", "input_tokens", "output_tokens",
        F.round("error_rate", 6).alias("error_rate"),
    )


@query("usage_minute", f"WITH {LOG}, {MINUTES} {MINUTE_ROW}")
def _(spark, sf):
    return minute_rows(serving.usage_per_minute(roles.requests(spark, sf)))


@query("usage_stream", f"""WITH {LOG}, {MINUTES} {MINUTE_ROW}
WHERE m + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM log) - INTERVAL 60 MINUTE""")
def _(spark, sf):
    """The minutes that are closed once the whole log has streamed in."""
    events = read_file_stream(spark, sf, roles.table(spark, sf, "events").schema, pattern="events.parquet")
    k = F.get_json_object("props", "$.k").cast("bigint")
    log = events.select(
        "ts", (k * 20).alias("input_tokens"), F.floor("value").alias("output_tokens"),
        F.when(k % 10 == 0, 429).when(k % 10 == 1, 503).when(k % 10 == 2, 400).otherwise(200).alias("status_code"),
    )
    path = scratch_path(spark, "usage")
    write_usage(stream_usage(log), f"{path}/minutes", f"{path}/checkpoint")
    return minute_rows(spark.read.parquet(f"{path}/minutes"))


@query("demand_minute", f"""WITH {LOG}, q AS (SELECT count(*) AS qpm FROM log GROUP BY date_trunc('minute', ts)),
s AS (SELECT qpm, row_number() OVER (ORDER BY qpm) - 1 AS i, count(*) OVER () AS n FROM q),
a AS (SELECT avg(input_tokens) AS i, avg(output_tokens) AS o FROM log)
SELECT percent, qpm::DOUBLE AS qpm, round(qpm * a.i, 6) AS itpm, round(qpm * a.o, 6) AS otpm
FROM s JOIN (SELECT unnest([75, 90]) AS percent) ON s.i = least(floor(n * percent / 100)::BIGINT, n - 1) CROSS JOIN a""")
def _(spark, sf):
    rows = serving.demand(roles.requests(spark, sf))
    return rows.select("percent", "qpm", F.round("itpm", 6).alias("itpm"), F.round("otpm", 6).alias("otpm"))


LIMITS = """limits AS (SELECT n_name AS model, 50000 + 20000 * n_nationkey AS itpm, 2000 + 1500 * (n_nationkey * 7 % 25) AS otpm,
  CASE WHEN n_nationkey % 4 > 0 THEN 300 * n_nationkey END AS qph FROM nation)"""


def model_limits(spark, sf):
    """A model for each nation; every fourth has no limit on its queries."""
    n = F.col("n_nationkey")
    return roles.table(spark, sf, "nation").select(
        F.col("n_name").alias("model"), (50000 + 20000 * n).alias("itpm"), (2000 + 1500 * (n * 7 % 25)).alias("otpm"),
        F.when(n % 4 > 0, 300 * n).alias("qph"),
    )


CEILING = """ceiling AS (SELECT model, itpm / a.i AS by_input, otpm / a.o AS by_output, qph / 60 AS by_queries,
  least(itpm / a.i, otpm / a.o, coalesce(qph / 60, 'infinity'::DOUBLE)) AS max_qpm
  FROM limits CROSS JOIN (SELECT avg(input_tokens) AS i, avg(output_tokens) AS o FROM {src}) a)"""


@query("capacity_ceiling", f"""WITH {WORDS}, {LIMITS}, {CEILING.format(src='profile')}
SELECT model, round(by_input, 6) AS by_input, round(by_output, 6) AS by_output, round(by_queries, 6) AS by_queries,
  CASE max_qpm WHEN by_input THEN 'ITPM' WHEN by_output THEN 'OTPM' ELSE 'QPH' END AS binding,
  round(max_qpm, 6) AS max_qpm FROM ceiling""")
def _(spark, sf):
    rows = serving.capacity_ceiling(roles.turns(spark, sf), model_limits(spark, sf))
    return rows.select("model", "binding", *[F.round(c, 6).alias(c) for c in ("by_input", "by_output", "by_queries", "max_qpm")])


@query("tier_needed", f"""WITH {LOG}, {LIMITS}, {CEILING.format(src='log')},
q AS (SELECT count(*) AS qpm FROM log GROUP BY date_trunc('minute', ts)),
s AS (SELECT qpm, row_number() OVER (ORDER BY qpm) - 1 AS i, count(*) OVER () AS n FROM q)
SELECT model, percent, qpm::DOUBLE AS qpm, round(max_qpm, 6) AS max_qpm,
  CASE WHEN qpm < max_qpm THEN 'pay-per-token' ELSE 'provisioned' END AS tier
FROM s JOIN (SELECT unnest([75, 90]) AS percent) ON s.i = least(floor(n * percent / 100)::BIGINT, n - 1) CROSS JOIN ceiling""")
def _(spark, sf):
    log = roles.requests(spark, sf)
    rows = serving.tier_needed(serving.demand(log), serving.capacity_ceiling(log, model_limits(spark, sf)))
    return rows.withColumn("max_qpm", F.round("max_qpm", 6))


@query("frontier_qpm", f"""WITH {WORDS}, r AS (SELECT *, input_tokens::DOUBLE AS i, output_tokens::DOUBLE AS o FROM profile)
SELECT conv_id, turn, round(1 / nullif(i / 400000 + o / 100000, 0), 6) AS qpm_1x,
  round(1 / nullif(i / 800000 + o / 200000, 0), 6) AS qpm_2x,
  round(least(210000 / nullif(o + i * 0.05::DOUBLE, 0), 250000 / nullif(o + i * 0.25::DOUBLE, 0)), 6) AS qpm_combined FROM r""")
def _(spark, sf):
    rows = serving.with_frontiers(roles.turns(spark, sf))
    return rows.select("conv_id", "turn", *[F.round(c, 6).alias(c) for c in ("qpm_1x", "qpm_2x", "qpm_combined")])


@query("format_ratio", """WITH m AS (SELECT event_type AS format, sum((props::JSON ->> '$.k')::BIGINT)::BIGINT AS total_samples,
  sum(value::DECIMAL(18, 2))::DOUBLE AS elapsed_sec FROM events GROUP BY 1),
r AS (SELECT *, total_samples / elapsed_sec AS rate FROM m)
SELECT format, total_samples, elapsed_sec, round(rate, 6) AS samples_per_sec,
  round(elapsed_sec * 1000 / ceil(total_samples / 64), 6) AS ms_per_batch, round(rate / (SELECT min(rate) FROM r), 6) AS ratio FROM r""")
def _(spark, sf):
    metrics = roles.table(spark, sf, "events").select(
        F.col("event_type").alias("format"), F.get_json_object("props", "$.k").cast("bigint").alias("samples"),
        F.col("value").cast("decimal(18,2)").alias("seconds"),
    )
    report = relative_throughput(metrics, "format", "samples", "seconds", 64)
    return report.select("format", "total_samples", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in (
        "elapsed_sec", "samples_per_sec", "ms_per_batch", "ratio")])
