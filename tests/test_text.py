from pyspark.sql import functions as F

from tablewright.functions import columns, text
from tablewright.functions.tasks import map_concurrently, retrying
from pyspark.sql import types as T
import pytest

PAGES = [
    (1, '<p>x</p><div class="a"><div itemprop="articleBody" id=1> <div>in\nner</div> tail </div></div><div>no</div>'),
    (2, "<p>nothing</p>"), (3, None), (4, '<div itemprop="articleBody">open'),
    (5, '<img/><div itemprop="articleBody">a > b<br/></div>'),
]


def test_extract_element(spark):
    df = spark.createDataFrame(PAGES, "id int, html string")
    got = {r.id: r.t for r in df.select("id", text.extract_element()("html").alias("t")).collect()}
    assert got == {
        1: '<div itemprop="articleBody" id=1> <div>in\nner</div> tail </div>', 2: None, 3: None,
        4: '<div itemprop="articleBody">open', 5: '<div itemprop="articleBody">a > b<br/></div>',
    }


def test_article_markup(spark):
    df = spark.createDataFrame([("<ARTICLE id='x'>\n<b>T</b>ext</article ><article>2</article>",), ("<articles>no</articles>",)], "h string")
    got = [r.t for r in df.select(text.strip_tags(text.article_markup("h")).alias("t")).collect()]
    assert got == ["\nText", None]


def test_sitemap(spark):
    xml = ('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
           "<url><loc>http://a</loc></url><url><loc>http://b?x=1&amp;y=2</loc></url></urlset>")
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(text.sitemap_urls("x").alias("u")).first().u == ["http://a", "http://b?x=1&y=2"]


def test_template_and_messages(spark):
    df = spark.createDataFrame([("{question}", "why?", [("system", "s"), ("user", "last")]), ("c", "q", [])],
                               "context string, question string, messages array<struct<role:string,content:string>>")
    got = df.select(
        text.fill_template("A {context} B {question}{question}.", context="context", question="question").alias("t"),
        text.last_content("messages").alias("m")).collect()
    assert [(r.t, r.m) for r in got] == [("A {question} B why?why?.", "last"), ("A c B qq.", None)]
    assert df.select(text.format_passages(F.array("context", "question")).alias("p")).first().p == "Passage: {question}\nPassage: why?\n"


def test_word_count(spark):
    df = spark.createDataFrame([("",), ("  \n",), (" a  b\tc\n",), (None,)], "t string")
    assert [r.n for r in df.select(text.word_count("t").alias("n")).collect()] == [0, 0, 3, 0]


def test_columns(spark):
    df = spark.createDataFrame([("/a/b.c/video.one.mov", '["x","y"]', 7, "Gold"), ("plain", "[]", 1234567, None)],
                               "p string, j string, n bigint, tier string")
    got = df.select(
        columns.file_stem("p").alias("s"), columns.first_json_item("j").alias("f"),
        columns.numbered_key("ORD-", "n", 6).alias("k"), columns.label_code("tier", {"Gold": 2}).alias("c"),
        columns.label_code("tier", {"Gold": 2}, None).alias("d"),
        columns.bucketize("n", [(">=", 8, "big")], "small").alias("b")).collect()
    assert [tuple(r) for r in got] == [
        ("video.one", "x", "ORD-000007", 2.0, 2.0, "small"), ("plain", None, "ORD-1234567", 0.0, None, "big")]


def test_retrying():
    pauses, calls = [], []

    @retrying((KeyError,), max_retries=3, jitter=False, sleep=pauses.append, max_delay=3)
    def flaky(ok_after):
        calls.append(1)
        if len(calls) <= ok_after:
            raise KeyError("no")
        return "done"

    assert flaky(3) == "done" and pauses == [1.0, 2.0, 3.0]
    calls.clear()
    with pytest.raises(KeyError):
        flaky(4)
    assert len(calls) == 4


def test_map_concurrently(spark):
    df = spark.range(40).repartition(3)
    got = map_concurrently(df, "id", lambda x: int(x) * 2, "twice", T.LongType(), threads=4)
    assert {(r.id, r.twice) for r in got.collect()} == {(i, 2 * i) for i in range(40)}
