"""The operators against brute force, and on nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tablewright.llm import (
    decontamination, licenses, mixing, near_duplicates, pii, quality, substrings, token_counts, toxicity, warc,
)
from tablewright.llm.oracles import LOWER  # noqa: F401  the SQL module imports alone
from tablewright.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.compare import connect, differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, spans int, copy string, kept int"


def docs_of(spark, texts):
    rows = [(i if i != 99 else None, t, None if i % 5 == 4 else "en", None if i % 4 == 3 else "s", len(t or ""), "x", 1, "y", 2)
            for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    prose = " ".join(f"word{i}" for i in range(60))
    return docs_of(spark, [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "One"), (6, prose), (6, prose), (7, prose + " end"),
                           (99, prose), (8, long), (9, "a b"), (10, "é ß 漢字 mail a@b.co\n\nmail")])


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")
    return {n: read(n) for n in ("documents", "labels", "benchmark", "pages")}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert differences(LLM_QUERIES[name](spark, sf), connect(sf), LLM_ORACLES[name]) == []


def python_quality(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set()
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_measures(tables, edge):
    for docs in (tables["documents"], edge):
        found, names = quality.measured(docs.select("doc_id", "text"))
        for r in found.select("text", *(names[n] for n in (*quality.COUNTS, "base_failed"))).collect():
            assert tuple(r)[1:] == python_quality(r.text)


def test_binomial_tail_and_cutoffs(spark):
    from math import comb
    from pyspark.sql import functions as F

    rows = [(40, 0), (40, 1), (200, 3), (3000, 12), (10, 9)]
    got = spark.createDataFrame(rows, "n long, k long").select("n", "k", quality.tail(F.col("n"), F.col("k"), 0.03).alias("p")).collect()
    for r in got:
        exact = sum(comb(r.n, i) * 0.03**i * 0.97 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == (1.0 if r.k >= r.n * 0.03 else pytest.approx(exact, rel=1e-9))
    # one clean stratum with enough labels, two that have enough together, and the step before the good ones are hit
    data = [("en", True, 0.01) for _ in range(4000)] + [("en", False, 0.5)] * 50 + [("en", True, 0.3)] * 200 + [("en", False, 0.3)] * 300
    data += [(s, True, 0.0) for s in ("de", "fr") for _ in range(150)] + [("de", False, 0.5)] * 5
    labelled = spark.createDataFrame(data, "stratum string, good boolean, symbol_share double")
    table = sorted(quality.cutoff_table(labelled, rules=("symbol_share",)).collect())
    assert [(r.stratum, r.pooled, r.n_good, r.good_out, r.bad_out) for r in table] == [
        ("de", True, 300, 0, 5), ("en", False, 4200, 0, 50), ("fr", True, 300, 0, 5)]
    assert all(r.bound <= quality.DELTA / 3 and 0.3 < r.limits["symbol_share"] < 0.5 for r in table)
    # 0.98 ** 148 is above 0.05
    few = spark.createDataFrame([("de", True, 0.0)] * 148 + [("de", False, 0.5)] * 5, labelled.schema)
    assert quality.cutoff_table(few, rules=("symbol_share",)).collect() == []


def test_rejections_of_good_documents_stay_within_the_risk(spark):
    """Strata whose bad and good documents look alike: no sequence goes beyond the risk by more than chance allows."""
    draw = np.random.default_rng(7)
    true = {f"a{c}": 0.005 * i for i, c in enumerate("abcdefghij")}  # the share of good documents with a high measure
    data = [(s, bool(good), float(0.4 if draw.random() < (p if good else 0.9) else 0.0), float(draw.random() * 0.01))
            for s, p in true.items() for good in [1] * 1500 + [0] * 100]
    labelled = spark.createDataFrame(data, "stratum string, good boolean, symbol_share double, upper_share double")
    table = {r.stratum: r for r in quality.cutoff_table(labelled, rules=("symbol_share", "upper_share")).collect()}
    taken = {s for s, r in table.items() if r.limits["symbol_share"] < 0.4}
    assert {"aa", "ab"} <= taken and all(true[s] <= quality.RISK for s in taken)


BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BRUTE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_personal_data(spark, tables, edge):
    hard = docs_of(spark, list(enumerate([
        "a@b.c@d.e x@y@z.co .@a.b @x.y a@b", "1.2.3.4.5 1.2.3 256.1.1.1 9.1.2.3.4.5.6.7 0001.2.3.04", "+1 (555) 010-9999 +1+2 345 678 901 +1 .",
        "4111 1111 1111 1111 4111-1111 11111111-1 5500005555555559", "+49 4111111111111111 10.0.0.1 4111111111111111",
        "ftp://joe:pw@host.org/x http://plain.org account no. 12345678 IBAN: DE89370400440532013000 SSN 123-45-6789",
    ])))
    for docs in (tables["documents"], edge, hard):
        texts = docs.select("doc_id", "text").collect()
        got = pii.find(docs).collect()
        for r, t in zip(got, texts, strict=True):
            assert r.base_sha256 == hashlib.sha256(brute_spans(t.text).encode()).hexdigest()
    kinds = {s.split(":")[0] for s in pii.find(hard).collect()[5].spans.split(",")}
    assert kinds == {"email", "url", "account"}
    clean = pii.redact(hard)
    assert clean.columns == hard.columns
    assert "DE8937" not in clean.collect()[5].text and all(r.n_chars == len(r.text) for r in clean.collect())


def test_edge_rows_stay(edge, tables, spark):
    n = edge.count()
    assert decontamination.contamination(edge, tables["benchmark"]).count() == n
    assert decontamination.contamination(edge, tables["benchmark"].limit(0)).where("n_hit > 0").count() == 0
    assert licenses.scan(edge).count() == n
    assert quality.assess(edge, tables["labels"].limit(0)).count() == n
    assert token_counts.token_counts(edge).count() == n
    near = {(r.doc_id, r.n_shingles): r for r in near_duplicates.near_duplicates(edge).collect()}
    assert near[(5, 1)].component_id == 4 and near[(7, 60)].component_id == 6 and near[(None, 59)].component_id == 6
    assert near[(1, 0)].kept and not near[(None, 59)].kept
    assert sorted(r.doc_id for r in near_duplicates.deduplicate(edge).collect()) == [1, 2, 3, 4, 6, 8, 9, 10]
    cut = {r.doc_id: r for r in substrings.remove_repeats(edge).collect()}
    assert cut[6].n_removed == 60 and cut[7].n_removed == 60 and cut[7].n_words == 61 and cut[8].n_removed == 0 and cut[1].n_words == 0
    mixed = mixing.mix(edge)
    assert mixed.columns[: len(edge.columns)] == edge.columns and len(set(mixed.columns)) == len(mixed.columns)
    for stage in (lambda d: quality.keep_good(d, tables["labels"]), lambda d: decontamination.decontaminate(d, tables["benchmark"]),
                  near_duplicates.deduplicate, pii.redact):
        assert stage(edge).columns == edge.columns and stage(edge.limit(0)).count() == 0


def test_empty_tables(edge, tables):
    none = edge.limit(0)
    for made in (substrings.remove_repeats(none), near_duplicates.near_duplicates(none), mixing.mix(none), token_counts.token_counts(none),
                 toxicity.toxicity(none, tables["labels"].limit(0)), warc.round_trip(tables["pages"].limit(0)), pii.find(none)):
        assert made.count() == 0


def test_large_groups_are_split_alike(spark, monkeypatch):
    shared = " ".join(f"p{i}" for i in range(50))
    docs = docs_of(spark, [(i, f"left{i} {shared} right{i}") for i in range(30)])
    want = {i: 50 for i in range(30)}
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()} == want
    real = substrings.shared_places
    monkeypatch.setattr(substrings, "shared_places", lambda rows: real(rows, group=5))
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()} == want


def test_blocks_find_chains(spark, monkeypatch):
    words = [f"t{i}" for i in range(200)]
    chain = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(25)]
    docs = docs_of(spark, chain)
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    assert {r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == {0}


def test_token_counts_equal_the_tokenizer(tables, edge):
    encode = token_counts.encoder(token_counts.load_vocabulary()).encode_ordinary
    for docs in (tables["documents"], edge):
        want = sorted((r.doc_id or -1, len(encode(r.text or ""))) for r in docs.select("doc_id", "text").collect())
        got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.token_counts(docs, block_tokens=777).collect())
        assert got == want


def test_archive_breaks_are_found():
    whole = warc.record(5, "http://a/b", b"<html>", None)
    text = zlib.decompress(whole, 31)
    fields = warc.parsed(text)
    assert (fields["page_id"], fields["payload_digest"]) == (5, base64.b32encode(hashlib.sha1(b"<html>").digest()).decode())
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(text.replace(b"<html>", b"<HTML>"))


def test_toxicity_on_held_out_labels(spark):
    rng = np.random.default_rng(3)
    plain = [f"{a}{b}" for a in ("th", "on", "er", "an", "ti") for b in ("ion", "ed", "es", "le", "at", "ou")]
    bad = ["idiot", "worthless", "pathetic", "moron"]
    texts, labels = [], []
    for i in range(600):
        words = list(rng.choice(plain, 40))
        if i % 4 == 0:
            words[int(rng.integers(40))] = str(rng.choice(bad))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.train(texts[:400], np.array(labels[:400]))
    data = list(enumerate([*texts[400:], "on worthles thion", "", None], 1000))
    got = [r.predicted for r in toxicity.scores(docs_of(spark, data), model).orderBy("doc_id").collect()]
    assert np.mean(np.array(got[:200]) == labels[400:]) > 0.97 and got[-3:] == [1, 0, 0]


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and out.columns[:5] == docs.columns
    kept = {r.doc_id for r in quality.assess(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    ids = {r.doc_id for r in out.collect()}
    assert ids and ids <= kept
    texts = [r.text for r in out.collect()]
    assert not any(brute_spans(t) for t in texts)


def test_toxicity_reads_long_words_to_the_end(spark):
    rng = np.random.default_rng(5)
    plain = [f"{a}{b}" for a in ("th", "on", "er", "an", "ti") for b in ("ion", "ed", "es", "le", "at", "ou")]
    texts = [" ".join(rng.choice(plain, 20)) + (" worthless" if i % 4 == 0 else "") for i in range(400)]
    model = toxicity.train(texts, np.array([int(i % 4 == 0) for i in range(400)]))
    line = ",".join(plain)
    long = [f"{line},worthless", f"{line}_worthless/{line}", line, "x" * 70 + "worthless"]
    got = [r.predicted for r in toxicity.scores(docs_of(spark, list(enumerate(long))), model).orderBy("doc_id").collect()]
    assert got[:3] == [1, 1, 0]
    for word in long:
        found = {p[i : i + n] for p in toxicity.words(word) for n in toxicity.SIZES for i in range(len(p) - n + 1)}
        assert {word[i : i + n] for n in toxicity.SIZES for i in range(len(word) - n + 1)} <= found
