"""Queries over tables as such: scans, keys, versions, files, frames and payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewright.operators import frames, keyed, retrieval
from tablewright.operators.features import unseen_report
from tablewright.operators.rules import with_rule_id
from tablewright.plans import roles
from tablewright.plans.order_queries import BRANDS, RULES, joined, mined_rules
from tablewright.plans.registry import query
from tablewright.session import cut_lineage, scratch_path
from tablewright.sources import tables
from tablewright.streaming import requests, sync

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@query("scan_project", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_quantity >= 45 AND l_shipdate >= TIMESTAMP '1998-01-01'""")
def _(spark, sf):
    lines = tables.read_table(spark, f"{sf}/lineitem.parquet")
    return lines.where(
        (F.col("l_quantity") >= 45) & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_partkey", "l_quantity")


@query("casts", """SELECT o_orderkey, o_orderkey::DOUBLE AS key_double, o_custkey::VARCHAR AS user_text,
trunc(o_totalprice)::BIGINT AS price_whole, strftime(o_orderdate::DATE, '%Y-%m-%d') AS day,
(o_orderstatus = 'F')::INT::DOUBLE AS done, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS level,
TRY_CAST(o_orderstatus AS INTEGER) AS bad FROM orders""")
def _(spark, sf):
    return roles.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("double").alias("key_double"),
        F.col("o_custkey").cast("string").alias("user_text"),
        F.col("o_totalprice").cast("bigint").alias("price_whole"),
        F.to_date("o_orderdate").cast("string").alias("day"),
        (F.col("o_orderstatus") == "F").cast("float").cast("double").alias("done"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.col("o_orderstatus").try_cast("int").alias("bad"),
    )


@query("verify_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, count(*) = 25 AS matches FROM {n}" for n in NAMES))
def _(spark, sf):
    return tables.verify_counts({n: tables.read_table(spark, f"{sf}/{n}.parquet") for n in NAMES}, 25)


@query("generated_id", """SELECT row_number() OVER (ORDER BY url, page_id) AS id, page_id FROM pages""")
def _(spark, sf):
    pages = roles.table(spark, sf, "pages").select("url", "page_id")
    return tables.with_dense_id(pages, ["url", "page_id"]).select("id", "page_id")


@query("csv_round_trip", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    customers = roles.table(spark, sf, "customer")
    customers.write.csv(path)
    return tables.read_csv(spark, path, customers.schema)


@query("json_round_trip", """SELECT event_id, event_type, value, (props::JSON ->> '$.k')::BIGINT AS k FROM events""")
def _(spark, sf):
    path = scratch_path(spark, "json")
    props = F.from_json("props", "k bigint")
    roles.table(spark, sf, "events").select("event_id", "event_type", "value", props.alias("props")).write.json(path)
    schema = "event_id bigint, event_type string, value double, props struct<k:bigint>"
    return tables.read_json_docs(spark, path, schema).select("event_id", "event_type", "value", "props.k")


@query("file_inventory")
def _(spark, sf):
    files = tables.list_files(spark, sf, [".parquet"])
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


@query("manifest", """SELECT * FROM (SELECT 'parts' AS dataset_name, 2 AS lance_version, count(*) AS row_count FROM part)
UNION ALL SELECT 'suppliers', 1, count(*) FROM supplier""")
def _(spark, sf):
    path = scratch_path(spark, "manifest")
    part, supplier = roles.table(spark, sf, "part"), roles.table(spark, sf, "supplier")
    for name, df in (("parts", part), ("suppliers", supplier), ("parts", part)):
        tables.write_manifest(df, name, f"{sf}/{name}", path, "tester", "run-1")
    manifest = tables.read_manifest(spark, path)
    newest = [tables.newest_entry(manifest, n) for n in ("parts", "suppliers")]
    return newest[0].unionByName(newest[1]).select("dataset_name", "lance_version", "row_count")


@query("table_round_trip", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def _(spark, sf):
    """Files loaded into a table without some columns, rewritten in part under the same schema, and appended to."""
    first, second = (f"tablewright_orders_{uuid.uuid4().hex}" for _ in range(2))
    tables.parquet_to_table(spark, f"{sf}/orders.parquet", ["o_totalprice", "o_orderdate", "o_custkey"], first)
    loaded = tables.read_table(spark, first)
    tables.write_table(loaded, second)
    tables.write_table(loaded.where(F.col("o_orderstatus") != "P"), second, overwrite_schema=False)
    tables.append_table(loaded.where(F.col("o_orderstatus") == "P"), second)
    return tables.read_table(spark, second, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("load_stamp", """SELECT count(*) AS rows, count(*) AS row_ids, 36 AS id_length, 1::BIGINT AS load_times FROM orders""")
def _(spark, sf):
    """Random row ids are unique and one load has one time."""
    stamped = tables.with_load_stamp(roles.table(spark, sf, "orders"))
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("row_id").alias("row_ids"), F.max(F.length("row_id")).alias("id_length"),
        F.approx_count_distinct("loaded_at").alias("load_times"),
    )


@query("key_check", """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT sum(n)::BIGINT AS rows, count(*) FILTER (n > 1) AS duplicate_keys, 0::BIGINT AS null_keys FROM k""")
def _(spark, sf):
    return keyed.key_check(roles.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("keyed_rules", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)}
SELECT sha256(array_to_string(items, chr(2)) || chr(1) || consequent) AS rule_id, antecedent, consequent FROM rules""")
def _(spark, sf):
    """Rules with a surrogate key, published as a checked table."""
    mined = mined_rules(roles.baskets(spark, sf))
    path = scratch_path(spark, "rules")
    sync.publish(with_rule_id(mined), path, ["rule_id"], parts=8)
    keyed_rules = sync.read_table(spark, path)
    return keyed_rules.select("rule_id", joined(), "consequent")


OLD = "old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P')"
NEW = """new AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END
  AS o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW')"""


@query("change_feed", f"""WITH {OLD}, {NEW}
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
  CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change_type,
  coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice
FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice""")
def _(spark, sf):
    orders = roles.table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = orders.where(F.col("o_orderstatus") != "P").select(*columns)
    raised = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = orders.where(F.col("o_orderpriority") != "5-LOW").withColumn("o_totalprice", raised).select(*columns)
    return keyed.change_feed(old, new, ["o_orderkey"])


@query("sync_upsert", """WITH last AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1)
SELECT c_custkey AS o_custkey, coalesce(o_orderkey, -1) AS o_orderkey FROM customer LEFT JOIN last ON o_custkey = c_custkey
WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'""")
def _(spark, sf):
    """A table of every customer's newest order, kept up by the order log; finished orders leave it."""
    path = scratch_path(spark, "sync")
    start = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(-1).cast("bigint").alias("o_orderkey"),
        F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
    )
    sync.publish(start, f"{path}/table", ["o_custkey"], parts=8)
    log = sync.read_file_stream(spark, sf, roles.table(spark, sf, "orders").schema, pattern="orders.parquet").select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "delete").otherwise("update").alias("change_type"),
    )
    sync.triggered_sync(log, f"{path}/table", ["o_custkey"], F.struct("o_orderdate", "o_orderkey"), f"{path}/checkpoint")
    return sync.read_table(spark, f"{path}/table").select("o_custkey", "o_orderkey")


@query("index_sync", """SELECT doc_id, lang IN ('de', 'fr') AS embedded_again, true AS as_rebuilt FROM documents WHERE lang <> 'es'""")
def _(spark, sf):
    """A vector index kept up by changes: French texts are new, German ones are other texts, Spanish ones go."""
    path, lang = scratch_path(spark, "index"), F.col("lang")
    docs = roles.table(spark, sf, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("content"))
    old = docs.where(lang != "fr")
    changed = F.when(lang == "de", F.reverse("content")).otherwise(F.col("content"))
    new = docs.where(lang != "es").withColumn("content", changed).drop("lang")
    model = retrieval.fit_text_vectors(old)
    sync.publish(retrieval.embed_text(model, old).select("doc_id", "vector"), f"{path}/index", ["doc_id"], parts=8)
    kind = F.when(lang == "es", "delete").when(lang == "de", "update").otherwise("insert").alias("change_type")
    # each changed text arrives twice in one batch, its last version second
    steps = F.explode(F.array(F.struct(F.lit(1).alias("at"), F.lit("a draft").alias("content")), F.struct(F.lit(2).alias("at"), changed.alias("content"))))
    log = docs.where(lang.isin("de", "fr", "es")).select("doc_id", kind, steps.alias("s")).select("doc_id", "change_type", "s.*")
    log.write.parquet(f"{path}/log")
    stream = sync.read_file_stream(spark, f"{path}/log", log.schema)
    sync.index_sync(stream, f"{path}/index", model, "doc_id", "content", "at", f"{path}/checkpoint")
    rebuilt = retrieval.embed_text(model, new).select("doc_id", F.col("vector").alias("wanted"))
    found = sync.read_table(spark, f"{path}/index", with_batch=True)
    return found.join(rebuilt, "doc_id", "full_outer").select(
        "doc_id", (F.col(sync.BATCH) >= 0).alias("embedded_again"), F.col("vector").eqNullSafe(F.col("wanted")).alias("as_rebuilt")
    )


LATE_LOG = """days AS (SELECT event_id, ts, date_diff('day', (SELECT min(ts) FROM events)::DATE, ts::DATE) // 5 AS day FROM events),
log AS (
  SELECT event_id, ts, CASE event_type WHEN 'error' THEN day + 1 WHEN 'signup' THEN day + 5 ELSE day END AS file FROM days
  JOIN events USING (event_id, ts)
  UNION ALL SELECT event_id, ts, day + 1 FROM days JOIN events USING (event_id, ts) WHERE event_type = 'purchase'),
files AS (SELECT file, max(ts) AS newest, row_number() OVER (ORDER BY file) AS batch FROM log GROUP BY 1),
marks AS (SELECT file, date_trunc('millisecond', max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
  - INTERVAL 7 DAY AS mark FROM files)"""


@query("usage_late_log", f"""WITH {LATE_LOG}
SELECT event_id, min(log.file)::INTEGER AS file FROM log JOIN marks ON marks.file = log.file
WHERE mark IS NULL OR ts > mark GROUP BY 1""")
def _(spark, sf):
    """Events arrive in files of five days: errors one file late, sign-ups five, which is too late, purchases twice."""
    path, kind = scratch_path(spark, "late"), F.col("event_type")
    events = roles.table(spark, sf, "events")
    # one row: the first day
    first = events.agg(F.min(F.to_date("ts"))).first()[0]
    day = F.floor(F.datediff(F.to_date("ts"), F.lit(first)) / 5)
    files = F.when(kind == "error", F.array(day + 1)).when(kind == "signup", F.array(day + 5)).when(
        kind == "purchase", F.array(day, day + 1)).otherwise(F.array(day))
    log = cut_lineage(events.select("event_id", "ts", F.explode(files.cast("array<int>")).alias("file")))
    for file in sorted(r["file"] for r in log.select("file").distinct().collect()):  # a file for every five days
        log.where(F.col("file") == file).coalesce(1).write.mode("append").parquet(f"{path}/log")
    stream = sync.read_file_stream(spark, f"{path}/log", log.schema, files_per_batch=1)
    accepted = requests.accepted_requests(stream, "event_id", "7 days").select("event_id", "file")
    sync.incremental_append(accepted, f"{path}/accepted", f"{path}/checkpoint")
    return spark.read.schema("event_id long, file int").parquet(f"{path}/accepted")


@query("incremental_append", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    path = scratch_path(spark, "append")
    events = sync.read_file_stream(spark, sf, roles.table(spark, sf, "events").schema, pattern="events.parquet")
    for _ in range(2):
        sync.incremental_append(events.select("event_id", "event_type"), f"{path}/rows", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows")


@query("unseen_report", """SELECT count(*) AS total, count(l.doc_id) AS linked, count(*) - count(l.doc_id) AS dropped
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""")
def _(spark, sf):
    docs = roles.table(spark, sf, "documents").select("doc_id")
    return unseen_report(docs, [("doc_id", roles.table(spark, sf, "labels"))])


VIDEOS = """videos AS (SELECT doc_id AS video_id, n_chars AS n_frames, (24 + doc_id % 7)::DOUBLE AS video_fps FROM documents),
steps AS (SELECT *, greatest(1, round_even(video_fps / 2, 0)::BIGINT) AS step FROM videos WHERE n_frames > 0),
frames AS (SELECT video_id, frame_number, floor(frame_number / video_fps * 1000)::BIGINT AS timestamp_ms
  FROM (SELECT video_id, video_fps, unnest(range(0, n_frames, step)) AS frame_number FROM steps))"""


@query("frame_sampling", f"""WITH {VIDEOS} SELECT video_id, frame_number::INTEGER AS frame_number, timestamp_ms FROM frames""")
def _(spark, sf):
    return frames.sample_frames(roles.videos(spark, sf), fps=2.0)


@query("trimmed_frames", f"""WITH {VIDEOS}, c AS (SELECT * FROM frames WHERE video_id IN
  (SELECT video_id FROM videos ORDER BY video_id LIMIT 15))
SELECT video_id, frame_number::INTEGER AS frame_number FROM c ORDER BY video_id, frame_number LIMIT 1000""")
def _(spark, sf):
    chosen = frames.select_videos(roles.videos(spark, sf), 1000, fps=2.0)
    return frames.trim_frames(frames.sample_frames(chosen, fps=2.0), 1000).select("video_id", "frame_number")


SEGMENTS = """segments AS (SELECT video_id, i AS segment_id, i * 9000 AS start_ms, i * 9000 + 7000 AS end_ms FROM
  (SELECT video_id, unnest(range(0, floor(floor(n_frames / video_fps * 1000) / 9000)::BIGINT + 1)) AS i FROM videos))"""


@query("segment_align", f"""WITH {VIDEOS}, {SEGMENTS}
SELECT f.video_id, segment_id, count(*) AS frames, min(frame_number)::INTEGER AS first_frame,
  max(frame_number)::INTEGER AS last_frame FROM frames f JOIN segments s ON f.video_id = s.video_id
  AND timestamp_ms >= start_ms AND timestamp_ms < end_ms GROUP BY 1, 2""")
def _(spark, sf):
    sampled = frames.sample_frames(roles.videos(spark, sf), fps=2.0)
    aligned = frames.align_segments(sampled, roles.segments(spark, sf))
    return aligned.groupBy("video_id", "segment_id").agg(
        F.count(F.lit(1)).alias("frames"), F.min("frame_number").alias("first_frame"),
        F.max("frame_number").alias("last_frame"),
    )


BOXES = """boxes AS (SELECT 'doc' || doc_id || '.v1' AS video_id, 0 AS position, lang AS category,
    (doc_id % 100)::DOUBLE AS x1, (doc_id % 50)::DOUBLE AS y1, (doc_id % 100 + 10)::DOUBLE AS x2, (doc_id % 50 + 20)::DOUBLE AS y2
  FROM documents WHERE doc_id % 5 <> 0
  UNION ALL SELECT 'doc' || doc_id || '.v1', 1, source, 1.5, 2.5, n_chars::DOUBLE, 4.5 FROM documents
  WHERE doc_id % 5 <> 0 AND n_chars > 500)"""


def label_documents(spark, sf):
    """A label document per text, as JSON: two boxes, one of them missing for short texts, and a bare label."""
    i = F.col("doc_id")

    def box(x1, y1, x2, y2):
        return F.struct(*[v.cast("double").alias(n) for v, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])

    first = F.struct(F.col("lang").alias("category"), box(i % 100, i % 50, i % 100 + 10, i % 50 + 20).alias("box2d"))
    second = F.struct(
        F.col("source").alias("category"),
        F.when(F.col("n_chars") > 500, box(F.lit(1.5), F.lit(2.5), F.col("n_chars"), F.lit(4.5))).alias("box2d"),
    )
    return roles.table(spark, sf, "documents").select(
        F.concat(F.lit("videos/doc"), i.cast("string"), F.lit(".v1.mov")).alias("name"),
        F.when(i % 5 != 0, F.to_json(F.array(first, second))).alias("labels"),
    )


@query("annotations", f"WITH {BOXES} SELECT * FROM boxes")
def _(spark, sf):
    docs = label_documents(spark, sf).withColumn("labels", F.from_json("labels", frames.LABELS))
    found = frames.parse_annotations(docs)
    return found.select("video_id", F.posexplode("bbox_labels").alias("position", "b")).select(
        "video_id", "position", "b.category", *[F.col(f"b.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    )


@query("attached_annotations", f"""WITH {BOXES}, {VIDEOS}
SELECT 'doc' || f.video_id || '.v1' AS video_id, count(*) AS frames, any_value(coalesce(n, 0)) AS boxes
FROM frames f LEFT JOIN (SELECT video_id, count(*) AS n FROM boxes GROUP BY 1) b ON b.video_id = 'doc' || f.video_id || '.v1'
GROUP BY 1""")
def _(spark, sf):
    docs = label_documents(spark, sf).withColumn("labels", F.from_json("labels", frames.LABELS))
    sampled = frames.sample_frames(roles.videos(spark, sf), fps=2.0).withColumn(
        "video_id", F.concat(F.lit("doc"), F.col("video_id").cast("string"), F.lit(".v1"))
    )
    attached = frames.attach_annotations(sampled, frames.parse_annotations(docs))
    return attached.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("frames"), F.max(F.size("bbox_labels")).cast("long").alias("boxes")
    )


@query("blob_report", """SELECT scheme, rows, bytes, round(m, 6) AS row_bytes, floor(134217728 / m)::BIGINT AS rows_per_group,
round(floor(134217728 / m) * m - m, 4) AS wasted_bytes FROM (SELECT split_part(url, ':', 1) AS scheme, count(*) AS rows,
  sum(strlen(html))::BIGINT AS bytes, sum(strlen(html)) / count(*) AS m FROM pages GROUP BY 1)""")
def _(spark, sf):
    pages = roles.table(spark, sf, "pages").withColumn("scheme", F.split_part("url", F.lit(":"), F.lit(1)))
    report = frames.blob_report(pages, "html", "scheme")
    return report.withColumns({"row_bytes": F.round("row_bytes", 6), "wasted_bytes": F.round("wasted_bytes", 4)})


@query("payload_join", """SELECT page_id, strlen(html) AS bytes, md5(html) AS digest FROM pages WHERE url LIKE 'https:%'""")
def _(spark, sf):
    path = scratch_path(spark, "payloads")
    frames.write_payload_layout(roles.table(spark, sf, "pages"), "page_id", "html", path)
    chosen = frames.read_metadata(spark, path).where(F.col("url").startswith("https:")).select("page_id")
    found = frames.fetch_payloads(spark, path, chosen, "page_id")
    return found.select("page_id", F.octet_length("html").cast("long").alias("bytes"), F.md5("html").alias("digest"))
