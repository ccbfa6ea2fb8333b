import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tablewright.operators import keyed
from tablewright.session import scratch_path, shared_dir
from tablewright.sources import synthetic, tables
from tablewright.streaming import requests, sync
from tablewright.operators.retrieval import embed_text, fit_text_vectors
from tablewright.operators.serving import usage_per_minute

KV = "k int, v string"


def kv(spark, rows):
    return spark.createDataFrame(rows, KV)


def test_key_check(spark):
    df = kv(spark, [(1, "a"), (1, "b"), (None, "c"), (2, "d")])
    assert tuple(keyed.key_check(df, ["k"]).first()) == (4, 1, 1)
    with pytest.raises(ValueError):
        keyed.require_key(df, ["k"])
    assert keyed.require_key(df, ["k", "v"].copy()[1:]).count() == 4


def test_change_feed_and_apply(spark):
    old = kv(spark, [(1, "a"), (2, "b"), (3, None), (4, "x")])
    new = kv(spark, [(1, "a"), (2, "B"), (3, None), (5, "n"), (4, None)])
    feed = keyed.change_feed(old, new, ["k"])
    assert {tuple(r) for r in feed.collect()} == {(2, "update", "B"), (5, "insert", "n"), (4, "update", None)}
    back = keyed.change_feed(new, old, ["k"])
    assert (5, "delete", "n") in {tuple(r) for r in back.collect()}
    assert sorted(map(tuple, keyed.apply_changes(old, feed, ["k"]).collect())) == sorted(map(tuple, new.collect()))
    assert sorted(map(tuple, keyed.apply_changes(new, back, ["k"]).collect())) == sorted(map(tuple, old.collect()))


def lose_last_commit(marks, away):
    """The stream as after a failure between the write of a batch and its commit."""
    commits = sorted((f for f in os.listdir(f"{marks}/commits") if f.isdigit()), key=int)
    os.replace(f"{marks}/commits/{commits[-1]}", f"{away}/lost")
    for name in os.listdir(f"{marks}/commits"):
        if name.startswith(f".{commits[-1]}."):
            os.replace(f"{marks}/commits/{name}", f"{away}/lost.crc")
    return int(commits[-1])


def test_sync_equals_batch_and_survives_a_rerun(spark, tmp_path):
    source, target, marks = (str(tmp_path / d) for d in ("in", "table", "marks"))
    schema = "k int, v string, t int, change_type string"
    sync.publish(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int"), target, ["k"], parts=2)

    def arrive(rows):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        sync.triggered_sync(sync.read_file_stream(spark, source, schema), target, ["k"], "t", marks)
        return {tuple(r) for r in sync.read_table(spark, target).collect()}

    assert arrive([(1, "A", 1, "update"), (1, "AA", 2, "update"), (3, "c", 1, "insert")]) == {(1, "AA", 2), (2, "b", 0), (3, "c", 1)}
    wanted = {(1, "AA", 2), (3, "c", 1), (4, "d", 1)}
    assert arrive([(2, None, 3, "delete"), (4, "d", 1, "insert")]) == wanted
    batch = lose_last_commit(marks, tmp_path)
    assert arrive([]) == wanted
    # a staged copy that a failed run left behind is taken as it is
    lose_last_commit(marks, tmp_path)
    staged = sync.placed(spark.createDataFrame([(9, "left", 9, batch, False)], f"k int, v string, t int, {sync.BATCH} long, {sync.DELETED} boolean"), ["k"], 2)
    staged.write.partitionBy("part_of_2").parquet(f"{marks}-staged/batch={batch}")
    assert (9, "left", 9) in arrive([])
    assert os.listdir(f"{marks}-staged") == []
    # a partition whose keys are all deleted has no rows in force
    assert arrive([(k, None, 10, "delete") for k in (1, 2, 3, 4, 9)]) == set()
    assert arrive([(1, "again", 11, "insert")]) == {(1, "again", 11)}


def test_a_stream_with_a_new_checkpoint_builds_on_the_table(spark, tmp_path):
    target, schema = str(tmp_path / "table"), "k int, v string, t int, change_type string"
    sync.publish(spark.createDataFrame([(1, "base", 0), (2, "base", 0)], "k int, v string, t int"), target, ["k"])
    for name, change in (("first", (1, "first", 1, "update")), ("second", (2, "second", 1, "update"))):
        source = str(tmp_path / name)
        spark.createDataFrame([change], schema).write.parquet(source)
        sync.triggered_sync(sync.read_file_stream(spark, source, schema), target, ["k"], "t", str(tmp_path / f"{name}-marks"))
    assert {tuple(r) for r in sync.read_table(spark, target).collect()} == {(1, "first", 1), (2, "second", 1)}


def test_sync_rewrites_only_touched_partitions(spark, tmp_path):
    source, target, marks = (str(tmp_path / d) for d in ("in", "table", "marks"))
    start = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("t"))
    sync.publish(start, target, ["k"], parts=16)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(target) for f in names if f.endswith(".parquet")}
    before = files()
    schema = "k int, t int, change_type string"
    spark.createDataFrame([(7, 1, "update")], schema).write.parquet(source)
    sync.triggered_sync(sync.read_file_stream(spark, source, schema), target, ["k"], "t", marks, parts=4)
    assert len({os.path.dirname(f) for f in before ^ files()}) == 1 and len(before) >= 16
    got = {r.k: r.t for r in sync.read_table(spark, target).collect()}
    assert got == {i: int(i == 7) for i in range(200)}


def test_sync_into_nothing(spark, tmp_path):
    source, target, marks = (str(tmp_path / d) for d in ("in", "table", "marks"))
    schema = "k int, t int, change_type string"
    spark.createDataFrame([(1, 1, "insert"), (2, 1, "insert"), (2, 2, "delete")], schema).write.parquet(source)
    sync.triggered_sync(sync.read_file_stream(spark, source, schema), target, ["k"], "t", marks)
    assert [tuple(r) for r in sync.read_table(spark, target).collect()] == [(1, 1)]


def test_accepted_requests(spark, tmp_path):
    source, day = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    schema = "ts timestamp_ntz, id int"
    at = lambda minutes: day + dt.timedelta(minutes=minutes)
    # a repetition in the second file; in the third a late row and one that is too late, as the mark is 120 - 60
    for rows in ([(at(0), 1), (at(0), 1), (at(120), 2)], [(at(120), 2), (at(200), 5)], [(at(61), 3), (at(60), 4), (at(200), 5)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    accepted = requests.accepted_requests(sync.read_file_stream(spark, source, schema, files_per_batch=1), "id")
    sync.incremental_append(accepted, str(tmp_path / "out"), str(tmp_path / "marks"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 5]


def test_incremental_append_reads_each_file_once(spark, tmp_path):
    source, target, marks = (str(tmp_path / d) for d in ("in", "out", "marks"))
    for i in range(3):
        kv(spark, [(i, "x")]).coalesce(1).write.mode("append").parquet(source)
        sync.incremental_append(sync.read_file_stream(spark, source, KV), target, marks)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [0, 1, 2]


def test_sync_vectors_embeds_only_changes(spark):
    old = spark.createDataFrame([(1, "one fish"), (2, "two fish"), (3, "red fish")], "id int, content string")
    new = spark.createDataFrame([(1, "one fish"), (2, "blue fish"), (4, "new fish")], "id int, content string")
    model = fit_text_vectors(old, dimensions=64)
    index = embed_text(model, old).withColumn("vector", F.transform("vector", lambda x: x + 100)).select("id", "vector")
    got = {r.id: r.vector for r in sync.sync_vectors(old, new, index, model, "id", "content").collect()}
    assert set(got) == {1, 2, 4}
    assert min(got[1]) >= 100 and max(got[2]) <= 1 and max(got[4]) <= 1


def test_stream_usage_equals_batch(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=37 * i), i % 50, i % 7, 500 if i % 9 == 0 else 200) for i in range(400)]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, input_tokens int, output_tokens int, status_code int")
    source = str(tmp_path / "in")
    log.repartition(3).write.parquet(source)
    usage = requests.stream_usage(sync.read_file_stream(spark, source, log.schema))
    requests.write_usage(usage, str(tmp_path / "out"), str(tmp_path / "marks"))
    got = {r.minute: tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.minute: tuple(r)[1:] for r in usage_per_minute(log.withColumn("ts", F.col("ts").cast("timestamp"))).collect()}
    closed = rows[-1][0] - dt.timedelta(minutes=61)
    assert got == {m: v for m, v in batch.items() if m <= closed} and len(got) > 100


def test_csv_and_files(spark, tmp_path):
    path = str(tmp_path / "c")
    kv(spark, [(1, "a,b"), (2, 'q"')]).write.csv(path)
    assert tables.read_csv(spark, path).columns == ["_c0", "_c1"]
    assert {tuple(r) for r in tables.read_csv(spark, path, KV).collect()} == {(1, "a,b"), (2, 'q"')}
    listed = tables.list_files(spark, path, [".CSV"])
    assert listed.count() >= 1 and set(listed.columns) == {"path", "length", "modificationTime"}
    assert tables.new_files(listed, listed).count() == 0
    (tmp_path / "c" / "more.csv").write_text("3,c\n")
    assert tables.new_files(tables.list_files(spark, path, [".csv"]), spark.createDataFrame(listed.collect()[:0], listed.schema)).count() > 0


def test_payloads(spark, tmp_path):
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.jpg").write_bytes(b"bytes")
    refs = spark.createDataFrame([(1, str(tmp_path / "img" / "a.jpg")), (2, str(tmp_path / "img" / "gone.jpg"))], "id int, image_path string")
    got = {r.id: r.content and bytes(r.content) for r in tables.read_payloads(spark, refs, "image_path", str(tmp_path / "img")).collect()}
    assert got == {1: b"bytes", 2: None}
    uris = refs.withColumn("image_path", F.concat(F.lit("file://"), "image_path"))
    read = tables.read_payloads(spark, uris, "image_path", str(tmp_path / "img"))
    assert read.columns == ["id", "image_path", "content"] and {r.id: r.content and bytes(r.content) for r in read.collect()} == got
    many = refs.unionByName(spark.createDataFrame([(3, (tmp_path / "img" / "a.jpg").as_uri())], refs.schema)).coalesce(1)
    fetched = tables.fetch_payloads_by_path(many, "image_path", threads=2, chunk=2)
    assert {r.id: r.content and bytes(r.content) for r in fetched.collect()} == {1: b"bytes", 2: None, 3: b"bytes"}


def test_tables_and_guards(spark, tmp_path):
    name = "tw_test_table"
    path = str(tmp_path / "warehouse_src")
    kv(spark, [(1, "a")]).write.parquet(path)
    tables.parquet_to_table(spark, path, ["v"], name)
    assert tables.read_table(spark, name).columns == ["k"]
    with pytest.raises(ValueError):
        tables.write_table(kv(spark, [(1, "a")]), name, overwrite_schema=False)
    tables.write_table(kv(spark, [(1, "a")]), name)
    tables.append_table(kv(spark, [(2, "b")]), name)
    assert tables.read_table(spark, name, ["v"]).count() == 2
    assert len(tables.report_rows(tables.read_table(spark, name), 1)) == 1
    counts = tables.verify_counts({"t": tables.read_table(spark, name)}, {"t": 2}).first()
    assert tuple(counts) == ("t", 2, True)
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        tables.require_rows(kv(spark, []), "nothing")
    short = tables.short_classes(kv(spark, [(1, "a"), (2, "a"), (3, "b")]), "v", ["a", "b", "c"], 2)
    assert {tuple(r) for r in short.collect()} == {("b", 1), ("c", 0)}


def test_ids(spark):
    df = tables.local_rows(spark, [(3, "c"), (1, "a"), (2, "b")], KV).repartition(3)
    assert {(r.k, r.id) for r in tables.with_dense_id(df, ["k"]).collect()} == {(1, 1), (2, 2), (3, 3)}
    assert tables.with_loose_id(df).select("id").distinct().count() == 3
    stamped = tables.with_load_stamp(df)
    assert stamped.select("row_id").distinct().count() == 3 and stamped.select("loaded_at").distinct().count() == 1


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    for rows in ([(1, "a")], [(1, "a"), (2, "b")]):
        tables.write_manifest(kv(spark, rows), "d", "/data/d", path, "me", "run")
    manifest = tables.read_manifest(spark, path)
    newest = tables.newest_entry(manifest, "d").first()
    assert (newest.lance_version, newest.row_count, newest.written_by) == (2, 2, "me")
    assert '"name":"k"' in newest.schema_json
    assert tables.newest_entry(manifest, "d", 1).first().row_count == 1


def test_synthetic_tables(spark):
    raw = synthetic.synthetic_orders(spark, 100, 4000)
    items = raw.select(F.split("order_products", ", ").alias("i"), "mpid", "order_id", "order_timestamp")
    names = {c: [i[0] for i in synthetic.ITEM_CATALOG if i[1] == c] for c in ("pizza", "side", "drink", "dessert")}

    def rate(options):
        return items.where(F.arrays_overlap("i", F.array(*[F.lit(o) for o in options]))).count() / 4000

    assert rate(names["pizza"]) == 1.0
    for options, want in ((names["side"], 0.6), (names["drink"], 0.5), (names["dessert"], 0.2),
                          (synthetic.SAUCES, 0.35), (synthetic.UTENSILS, 0.25)):
        assert rate(options) == pytest.approx(want, abs=0.04)
    assert items.select("mpid").distinct().count() == 100
    assert items.agg(F.min("order_id"), F.max("order_id"), F.min("order_timestamp"), F.max("order_timestamp")).first()[:2] == ("ORD-000001", "ORD-004000")
    again = synthetic.synthetic_orders(spark, 100, 4000)
    assert raw.exceptAll(again).isEmpty()
    wide = synthetic.synthetic_wide(spark, 1000, 3, 4, partitions=5)
    stats = wide.agg(F.min("r_0"), F.max("r_0"), F.avg("r_1"), F.count_distinct("target")).first()
    assert wide.rdd.getNumPartitions() == 5 and 0 <= stats[0] < 0.05 and 0.95 < stats[1] <= 1 and abs(stats[2] - 0.5) < 0.05 and stats[3] == 4
    groups = synthetic.synthetic_groups(spark, 3, 2, 5)
    assert groups.count() == 15 and groups.columns == ["group_name", "features_0", "features_1", "target"]
    assert {r.group_name for r in groups.collect()} == {"group_01", "group_02", "group_03"}


def test_shared_dir(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
