"""Fill-in-the-middle texts against plain Python: every cut, mark and form, and the way back."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import fill_in_middle as fim

SIGNS = st.text(alphabet="ab<>PSM é漢🙂\0\n", max_size=40)


def python_row(doc_id, text, unit="points"):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    return plain_cut(text, h1, h2, h3, h4, unit)


def plain_cut(text, h1, h2, h3, h4, unit):
    raw = text.encode()
    room = len(text) if unit == "points" else len(raw)
    a, b = sorted((h1 % (room + 1), h2 % (room + 1)))
    if unit == "bytes":  # a cut within a character falls to its start
        a, b = (len(raw[:c].decode(errors="ignore")) for c in (a, b))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(text), "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(SIGNS, st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4)), max_size=8), st.sampled_from(["points", "bytes"]))
def test_any_texts_and_draws(rows, unit):
    draws = [np.array([d[k] for _, d in rows], np.int64) for k in range(4)]
    texts = pa.array(["x", *(t for t, _ in rows)], pa.string())[1:]  # a slice: offsets do not begin at nothing
    found = [c.to_pylist() for c in fim.transformed(texts, draws, unit)]
    assert list(zip(*found)) == [plain_cut(t, *d, unit) for t, d in rows]


@settings(max_examples=200, deadline=None)
@given(SIGNS)
def test_index_converts_both_ways(text):
    raw = text.encode()
    index = fim.ExceptionIndex(np.frombuffer(raw, np.uint8))
    points = np.arange(len(text) + 1)
    assert index.bytes_of(points).tolist() == [len(text[:k].encode()) for k in points]
    at = np.arange(len(raw) + 1)
    assert index.points_of(at).tolist() == [len(raw[:k].decode(errors="ignore")) for k in at]
    assert len(index.at_byte) == sum(ord(c) > 127 for c in text)


@pytest.mark.parametrize("unit", ["points", "bytes"])
def test_edge_rows_and_the_way_back(spark, unit):
    long = "漢字 and ASCII 🙂 " * 50_000
    texts = [None, "", "a", "<P>", "x <S> y", "<", "<P<S<M", "P>S>M>", "é" * 50, long, "plain words " * 9, "\0\n\t"]
    rows = [(i if i else None, t, "mine", i) for i, t in enumerate(texts * 12)] + [(5, "same", "mine", 1), (5, "same", "mine", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form int")
    out = fim.fill_in_middle(docs, unit)
    assert out.columns == ["doc_id", "text", "n", "form", "_n", "_form", "prefix_chars", "middle_chars", "output"]
    found = out.withColumn("back", fim.restored(F.col("output"), F.col("_form"))).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    wanted = sorted(((r[0], r[1], *python_row(r[0], r[1], unit)) for r in rows), key=key)
    got = sorted(((r.doc_id, r.text, r._n, r._form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=key)
    assert got == wanted
    assert all(r.back == (r.text or "") and r.n == "mine" for r in found)
    assert {r._form for r in found} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_unit_is_checked(spark):
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.range(1).selectExpr("id AS doc_id", "'a' AS text"), "words")
