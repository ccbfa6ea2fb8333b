"""Ids of any type and repeated ones, pages with gaps, weights as users give them, and offsets in long texts."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontamination, mixing, token_counts, toxicity, warc


def test_token_counts_keep_the_type_of_ids(spark):
    docs = spark.createDataFrame([("a-1", "one two"), (None, "one two"), ("é<>", None), ("a-1", "")], "doc_id string, text string")
    got = token_counts.token_counts(docs)
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    counts = sorted((r.doc_id or "", r.n_tokens) for r in got.collect())
    whole = counts[0][1]
    assert whole > 0 and counts == [("", whole), ("a-1", 0), ("a-1", whole), ("é<>", 0)]
    dated = docs.select(F.lit("2020-02-03").cast("date").alias("doc_id"), "text")
    assert {str(r.doc_id) for r in token_counts.token_counts(dated).collect()} == {"2020-02-03"}


def test_archives_keep_ids_of_any_type_and_pages_with_gaps(spark):
    long = "x" * (3 * warc.CHUNK) + "é"
    pages = spark.createDataFrame(
        [("b <1>", "http://h/é", "<p>", "t"), ("a:é", None, "<p>", "t"), ("a:é", None, "<p>", "t"), (None, "http://h", "<p>", None),
         ("n", "http://h", None, "t"), ("m", "http://h", "", "t"), ("z", "http://h", long, "t"), ("y", "http://h", long, "t")],
        "page_id string, url string, html string, record_type string",
    )
    got = sorted(
        ((r.page_id or "", r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()), key=str
    )
    size = len(long.encode())
    assert got == sorted([
        ("b <1>", 3, "revisit", "a:é"), ("a:é", 3, "response", None), ("a:é", 3, "response", None), ("", 3, "response", None),
        ("n", 0, "revisit", "m"), ("m", 0, "response", None), ("z", size, "revisit", "y"), ("y", size, "response", None),
    ], key=str)
    numbers = spark.createDataFrame([(10, "u", "p"), (9, "u", "p")], "page_id int, url string, html string")
    back = warc.round_trip(numbers)
    assert back.schema["page_id"].dataType.simpleString() == "int"
    assert {(r.page_id, r.refers_to) for r in back.collect()} == {(9, None), (10, 9)}  # by number: as text 10 comes first


def rates(spark, weights):
    sizes = spark.createDataFrame([("a", 100), ("b", 300), (None, 100), ("empty", 0)], "source string, size long")
    given = spark.createDataFrame(weights, "source string, weight double")
    return {r.source: r.rate for r in mixing.repetition(sizes, given).collect()}


def test_weights_that_repeat_add_up(spark):
    once = rates(spark, [("a", 2.0), ("b", 1.0), (None, 1.0), ("unknown", 5.0)])
    assert once == {"a": 2.5, "b": 125 / 300, None: 1.25, "empty": 1.0}
    assert rates(spark, [("a", 0.5), ("a", 1.5), ("b", 1.0), (None, 1.0), (None, None)]) == once
    assert rates(spark, [("a", 1.0)]) == {"a": 5.0, "b": 0.0, None: 0.0, "empty": 1.0}
    docs = spark.createDataFrame([(i, "s", "text") for i in range(100)], "doc_id long, source string, text string")
    twice = spark.createDataFrame([("s", 1.0), ("s", 1.0)], "source string, weight double")
    one = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    assert mixing.mix(docs, twice).count() == mixing.mix(docs, one).count()


@pytest.mark.parametrize("weight", [-0.1, float("nan"), float("inf")])
def test_weights_that_are_no_share_are_refused(spark, weight):
    with pytest.raises(Exception, match="finite and not negative"):
        rates(spark, [("a", 1.0), ("b", weight)])


def test_typed_ids_in_records():
    for page, other in ((5, None), (-5, 7), ("5", "007"), ("a <b>:é", "")):
        fields = warc.parsed(zlib.decompress(warc.record(page, "u", b"x", other), 31))
        assert (fields["page_id"], fields["refers_to"]) == (page, other)


def test_offsets_of_words_in_the_original_text():
    text = "  Été, 漢字 x\U0001f600y-z " * 50
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(decontamination.WORD_BYTES))]
    spans = [(i, i + 3) for i in range(len(at) - 2)]
    want = [(len(raw[: at[a][0]].decode()), len(raw[: at[b - 1][1]].decode())) for a, b in spans]
    assert decontamination.char_spans(text, spans) == want and decontamination.char_spans(text, []) == []


def test_windows_of_several_passes_equal_one_pass(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")
    found = []
    for limit in ({}, {"max_windows": 300}):
        scanned, names = decontamination.scan(read("documents"), read("benchmark"), **limit)
        found.append({r.doc_id: (r[names["spans"]], r[names["items"]]) for r in scanned.collect()})
    one, several = found
    assert one == several and any(spans for spans, _ in one.values())


def test_a_model_from_repeated_ids_does_not_depend_on_the_order(spark):
    rows = [(i % 60, f"plain words {i} here" + (" worthless" if i % 4 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    models = [toxicity.fit(d, labels) for d in (docs, docs.repartition(7), docs.orderBy(F.col("text").desc()))]
    for m in models[1:]:
        assert np.array_equal(m.embeddings, models[0].embeddings) and np.array_equal(m.weights, models[0].weights)
