"""Queries over vectors, texts and labels, and per-group models."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tablewright.functions import text
from tablewright.functions.columns import first_json_item, json_items
from tablewright.operators import buckets, evaluate, factors, groups, retrieval, term_index, vectors
from tablewright.operators.split import feature_target_split
from tablewright.plans import roles
from tablewright.plans.registry import query
from tablewright.session import write_once

NEIGHBOURS = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS corpus_id, round({score}, 6) AS score FROM v a CROSS JOIN v b),
hits AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score {way}, corpus_id)::INTEGER AS rank,
  corpus_id, score FROM pairs QUALIFY rank <= {k})"""
COSINE = "list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e))"
DOT = "list_dot_product(a.e, b.e)"
L2 = "sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


@query("cosine_topk", f"WITH {NEIGHBOURS.format(score=COSINE, way='DESC', k=5)} SELECT * FROM hits")
def _(spark, sf):
    return vectors.nearest(*roles.question_vectors(spark, sf), 5, "cosine")


@query("score_topk", f"WITH {NEIGHBOURS.format(score=DOT, way='DESC', k=10)} SELECT * FROM hits")
def _(spark, sf):
    return vectors.nearest(*roles.question_vectors(spark, sf), 10, "dot", block_rows=256)


@query("knn_exact", f"WITH {NEIGHBOURS.format(score=L2, way='ASC', k=3)} SELECT * FROM hits")
def _(spark, sf):
    return vectors.nearest(*roles.question_vectors(spark, sf), 3, "l2")


@query("knn_all_cells", f"WITH {NEIGHBOURS.format(score=COSINE, way='DESC', k=5)} SELECT * FROM hits")
def _(spark, sf):
    asked, known = roles.question_vectors(spark, sf)
    cells = max(1, round(known.count() ** 0.5))
    return vectors.nearest_in_cells(asked, known, 5, vectors.fit_cells(known, cells), probes=cells, block_rows=64)


LSH = buckets.Tables(tables=20, cuts=3, width=1.5)
IN_BUCKETS = f"""v AS (SELECT vec_id, embedding::DOUBLE[] AS e, len(embedding) AS n FROM embeddings),
noise AS (SELECT j, d, n, sin(j * (2 * n + 1) + d + 1) * 10000 AS s
  FROM (SELECT DISTINCT n FROM v), (SELECT unnest(range({LSH.tables * LSH.cuts})) AS j), (SELECT unnest(range(1000)) AS d) WHERE d < 2 * n + 1),
uniform AS (SELECT j, d, n, s - floor(s) AS u FROM noise),
cuts AS (
  SELECT a.j, list(sqrt(-2 * ln(greatest(a.u, 1e-12))) * cos(2 * pi() * b.u) ORDER BY a.d) AS r, any_value(o.u) AS shift
  FROM uniform a JOIN uniform b ON b.j = a.j AND b.d = a.d + a.n JOIN uniform o ON o.j = a.j AND o.d = 2 * o.n
  WHERE a.d < a.n GROUP BY 1),
placed AS (
  SELECT vec_id, j // {LSH.cuts} AS t, list(floor(list_dot_product(e, r) / sqrt(list_dot_product(e, e)) / {LSH.width} + shift) ORDER BY j) AS bucket
  FROM v CROSS JOIN cuts GROUP BY 1, 2),
met AS (SELECT DISTINCT a.vec_id AS query_id, b.vec_id AS corpus_id FROM placed a JOIN placed b USING (t, bucket)),
scored AS (SELECT query_id, corpus_id, round({COSINE}, 6) AS score
  FROM met JOIN v a ON a.vec_id = query_id JOIN v b ON b.vec_id = corpus_id)"""


@query("knn_buckets", f"""WITH {IN_BUCKETS}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id)::INTEGER AS rank, corpus_id, score
FROM scored QUALIFY rank <= 5""")
def _(spark, sf):
    """Neighbours among the vectors that share a bucket of tables of a given size."""
    return buckets.nearest_by_tables(*roles.question_vectors(spark, sf), 5, LSH)


@query("knn_recall", "SELECT 5 * count(*) AS wanted, true AS at_least_nine_tenths FROM embeddings")
def _(spark, sf):
    """Whether tables chosen for the corpus find at least nine tenths of the exact neighbours."""
    asked, known = roles.question_vectors(spark, sf)
    report = vectors.recall(buckets.search(asked, known, 5), vectors.nearest(asked, known, 5, "cosine"))
    return report.select("wanted", (F.col("recall") >= 0.9).alias("at_least_nine_tenths"))


@query("als_vectors_topk")
def _(spark, sf):
    matrix = factors.prepare(roles.user_orders(spark, sf))
    users, items = factors.unit_vectors(factors.fit(write_once(matrix.shares, "shares")), matrix)
    return vectors.nearest(
        users.select(F.col("mpid").alias("query_id"), F.col("embedding").alias("vector")),
        items.select(F.col("item_idx").alias("corpus_id"), F.col("embedding").alias("vector")), 5, "dot",
    )


@query("context_assembly", f"""WITH {NEIGHBOURS.format(score=COSINE, way='DESC', k=3)},
p AS (SELECT query_id, count(*) AS n_passages, string_agg('Passage: ' || text || chr(10), '' ORDER BY rank) AS context
  FROM hits JOIN documents ON doc_id = corpus_id GROUP BY 1),
f AS (SELECT query_id, n_passages, 'Context: ' || context || chr(10) || 'Question: ' || name AS prompt
  FROM p JOIN (SELECT doc_id, lang || '-' || source AS name FROM documents) ON doc_id = query_id)
SELECT query_id AS id, n_passages, length(prompt) AS n_chars, md5(prompt) AS digest FROM f""")
def _(spark, sf):
    docs = roles.table(spark, sf, "documents")
    hits = vectors.nearest(*roles.question_vectors(spark, sf), 3, "cosine")
    questions = docs.select(F.col("doc_id").alias("id"), F.concat_ws("-", "lang", "source").alias("question"))
    known = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    found = retrieval.assemble_prompts(hits, questions, known)
    prompt = text.fill_template(
        "Context: {context}\nQuestion: {question}", context=text.format_passages("passages"), question="question"
    )
    return found.select(
        "id", F.size("passages").cast("long").alias("n_passages"), prompt.alias("prompt")
    ).select("id", "n_passages", F.length("prompt").cast("long").alias("n_chars"), F.md5("prompt").alias("digest"))


@query("joined_passages", f"""WITH {NEIGHBOURS.format(score=COSINE, way='DESC', k=3)}
SELECT query_id AS id, md5(string_agg(text, chr(10) || chr(10) ORDER BY rank)) AS digest
FROM hits JOIN documents ON doc_id = corpus_id WHERE query_id IN (SELECT doc_id FROM documents) GROUP BY 1""")
def _(spark, sf):
    docs = roles.table(spark, sf, "documents")
    hits = vectors.nearest(*roles.question_vectors(spark, sf), 3, "cosine")
    questions = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("question"))
    known = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    found = retrieval.assemble_prompts(hits, questions, known)
    return found.select("id", F.md5(text.join_passages("passages")).alias("digest"))


ASKED = """asked AS (SELECT conv_id AS id, arg_max(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY 1)"""
TERMS = r"""said AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
counts AS (SELECT id, term, count(*) AS n FROM said GROUP BY ALL),
stats AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS rarity FROM counts GROUP BY 1),
d AS (SELECT id, term, n * rarity / sqrt(sum(n * rarity * n * rarity) OVER (PARTITION BY id)) AS weight FROM counts JOIN stats USING (term)),
spoken AS (SELECT id, unnest(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS term FROM asked),
q AS (SELECT id, term, n * rarity / sqrt(sum(n * rarity * n * rarity) OVER (PARTITION BY id)) AS weight
  FROM (SELECT id, term, count(*) AS n FROM spoken GROUP BY ALL) JOIN stats USING (term)),
alike AS (SELECT q.id AS query_id, d.id AS corpus_id, round(sum(q.weight * d.weight), 6) AS score FROM q JOIN d USING (term) GROUP BY ALL),
hits AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id)::INTEGER AS rank, corpus_id, score
  FROM alike QUALIFY rank <= 3)"""


def last_questions(spark, sf):
    said = roles.table(spark, sf, "conversations").where(F.col("role") == "user")
    return said.groupBy(F.col("conv_id").alias("id")).agg(F.max_by("text", "turn").alias("question"))


def known_texts(spark, sf):
    return roles.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


@query("text_topk", f"WITH {ASKED}, {TERMS} SELECT * FROM hits")
def _(spark, sf):
    """The texts most like the last user turn of every conversation."""
    return term_index.best_matches(last_questions(spark, sf), term_index.build_index(known_texts(spark, sf)), 3)


@query("retrieve_context", f"""WITH {ASKED}, {TERMS},
p AS (SELECT query_id, count(*) AS n_passages, string_agg('{text.PASSAGE[0]}' || text || chr(10), '' ORDER BY rank) AS context
  FROM hits JOIN documents ON doc_id = corpus_id GROUP BY 1),
f AS (SELECT id, n_passages, replace('{text.PROMPT}', '{{context}}', context) AS prompt FROM asked JOIN p ON query_id = id)
SELECT id, n_passages, length(prompt) AS n_chars, md5(prompt) AS digest FROM f""")
def _(spark, sf):
    """Prompts for the last user turn of every conversation, over all documents."""
    docs = known_texts(spark, sf)
    found = retrieval.retrieve_context(last_questions(spark, sf), docs, term_index.build_index(docs), k=3)
    return found.select(
        "id", F.size("passages").cast("long").alias("n_passages"), F.length("system_prompt").cast("long").alias("n_chars"),
        F.md5("system_prompt").alias("digest"),
    )


@query("last_turn", """SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, md5(arg_max(text, turn)) AS digest
FROM conversations GROUP BY 1""")
def _(spark, sf):
    messages = F.array(F.max_by(F.struct("role", F.col("text").alias("content")), "turn"))
    last = roles.table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.max("turn").alias("turn"), messages.alias("messages")
    )
    return last.select(
        "conv_id", "turn", F.get("messages", F.lit(0))["role"].alias("role"),
        F.md5(text.last_content("messages")).alias("digest"),
    )


@query("article_extract", r"""WITH a AS (SELECT page_id, regexp_extract(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>', 1) AS m FROM pages
  WHERE regexp_matches(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>')),
t AS (SELECT page_id, regexp_replace(m, '<[^>]*>', '', 'g') AS t FROM a)
SELECT page_id, length(t) AS n_chars, md5(t) AS digest FROM t""")
def _(spark, sf):
    pages = roles.texts(spark, sf, "pages")
    found = pages.select("page_id", text.strip_tags(text.article_markup("html")).alias("t")).where(F.col("t").isNotNull())
    return found.select("page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("digest"))


@query("article_element", r"""WITH a AS (SELECT page_id, regexp_extract(html, '(?is)<article(?:\s[^>]*)?>.*?</article\s*>', 0) AS m FROM pages
  WHERE regexp_matches(html, '(?is)<article(?:\s[^>]*)?>.*?</article\s*>'))
SELECT page_id, length(m) AS n_chars, md5(m) AS digest FROM a""")
def _(spark, sf):
    pages = roles.texts(spark, sf, "pages")
    found = pages.select("page_id", text.extract_element("article", {})("html").alias("m")).where(F.col("m").isNotNull())
    return found.select("page_id", F.length("m").cast("long").alias("n_chars"), F.md5("m").alias("digest"))


@query("sitemap_urls", """SELECT source, count(*) AS urls, min(u) AS first, max(u) AS last FROM
(SELECT split_part(url, '/', 3) AS source, regexp_replace(url, '&', '+', 'g') AS u FROM pages) GROUP BY 1""")
def _(spark, sf):
    """Every page's address goes through a site map of its own and back."""
    address = F.regexp_replace("url", "&", "+")
    xml = F.concat(
        F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'), address,
        F.lit("</loc></url></urlset>"),
    )
    pages = roles.table(spark, sf, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("source"), F.explode(text.sitemap_urls(xml)).alias("u")
    )
    return pages.groupBy("source").agg(
        F.count(F.lit(1)).alias("urls"), F.min("u").alias("first"), F.max("u").alias("last")
    )


@query("json_arrays", """SELECT p_partkey, p_brand AS first, 2 AS n FROM part""")
def _(spark, sf):
    packed = F.to_json(F.array("p_brand", "p_type"))
    parts = roles.table(spark, sf, "part").select("p_partkey", packed.alias("j"))
    return parts.select("p_partkey", first_json_item("j").alias("first"), F.size(json_items("j")).alias("n"))


SCORED = """scored AS (SELECT l.doc_id, quality AS y, (n_chars >= 1000)::INT AS a,
  (n_chars >= 400 AND lang <> 'de')::INT AS b FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
REPORT = """{n}_cls AS (SELECT c AS label, sum((y = c AND {p} = c)::INT) AS ok, sum(({p} = c)::INT) AS guessed,
  sum((y = c)::INT) AS support FROM scored CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY 1),
{n}_m AS (SELECT *, coalesce(ok / nullif(guessed, 0), 0) AS p, coalesce(ok / nullif(support, 0), 0) AS r FROM {n}_cls),
{n}_f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM {n}_m)"""


@query("classification_report", f"""WITH {SCORED}, {REPORT.format(n='a', p='a')},
rows AS (SELECT label::VARCHAR AS label, p, r, f, support FROM a_f
UNION ALL SELECT 'accuracy', sum(ok) / sum(support), sum(ok) / sum(support), sum(ok) / sum(support), sum(support) FROM a_f
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM a_f
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM a_f)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support::BIGINT AS support FROM rows""")
def _(spark, sf):
    report = evaluate.classification_report(roles.scored_labels(spark, sf), "y", "y_champion")
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@query("bakeoff", f"""WITH {SCORED}, {REPORT.format(n='a', p='a')}, {REPORT.format(n='b', p='b')},
w AS (SELECT (SELECT sum(f * support) / sum(support) FROM a_f) AS champion_f1,
  (SELECT sum(f * support) / sum(support) FROM b_f) AS challenger_f1)
SELECT round(champion_f1, 6) AS champion_f1, round(challenger_f1, 6) AS challenger_f1,
  challenger_f1 >= champion_f1 AS promote,
  CASE WHEN challenger_f1 >= champion_f1 THEN 'challenger' ELSE 'champion' END AS winner FROM w""")
def _(spark, sf):
    found = evaluate.bakeoff(roles.scored_labels(spark, sf), "y", "y_champion", "y_challenger")
    return found.withColumns({c: F.round(c, 6) for c in ("champion_f1", "challenger_f1")})


@query("classifier")
def _(spark, sf):
    """A logistic regression on simple document measures, judged on the held-out fifth."""
    docs = roles.texts(spark, sf, "documents")
    body = F.col("text")
    rows = roles.table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", F.log1p("n_chars").alias("size"),
        (F.length(F.regexp_replace(body, r"[^\p{L}]", "")) / F.greatest(F.length(body), F.lit(1))).alias("letters"),
        F.log1p(text.word_count(body)).alias("words"), "quality",
    )
    train, test = feature_target_split(rows, "doc_id", "quality")
    model = evaluate.fit_classifier(train, "quality")
    judged = model.transform(test).select(F.col("quality").alias("y"), F.col("y_hat").cast("int").alias("y_hat"))
    return evaluate.classification_report(judged)


VERSIONS = "versions AS (SELECT p_brand AS name, p_partkey AS version, (p_partkey * 37) % 1009 AS score FROM part)"


def versions(spark, sf):
    """Parts as versions of the model their brand stands for."""
    return roles.table(spark, sf, "part").select(
        F.col("p_brand").alias("name"), F.col("p_partkey").alias("version"),
        (F.col("p_partkey") * 37 % 1009).alias("score"),
    )


@query("latest_version", f"WITH {VERSIONS} SELECT name, max(version) AS latest_version FROM versions GROUP BY 1")
def _(spark, sf):
    return evaluate.latest_version(versions(spark, sf), "name", "version")


@query("model_aliases", f"""WITH {VERSIONS}, e AS (SELECT name, min(version) AS a, max(version) AS b,
  arg_min(score, version) AS sa, arg_max(score, version) AS sb FROM versions GROUP BY 1)
SELECT name, 'Champion' AS alias, CASE WHEN b > a AND sb >= sa THEN b ELSE a END AS version FROM e
UNION ALL SELECT name, CASE WHEN sb >= sa THEN 'Retired' ELSE 'Challenger' END,
  CASE WHEN sb >= sa THEN a ELSE b END FROM e WHERE b > a""")
def _(spark, sf):
    return evaluate.model_aliases(versions(spark, sf))


LINES = "lines AS (SELECT l_suppkey, l_quantity AS x, l_extendedprice AS y FROM lineitem)"


@query("group_regression", f"""WITH {LINES} SELECT l_suppkey, count(*) AS n_rows, round(regr_slope(y, x), 4) AS slope,
  round(regr_intercept(y, x), 4) AS intercept, round(regr_r2(y, x), 6) AS r2 FROM lines GROUP BY 1""")
def _(spark, sf):
    found = groups.simple_regression(roles.table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    return found.select(
        "l_suppkey", "n_rows", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"),
    )


@query("group_fit", f"""WITH {LINES} SELECT l_suppkey, count(*) AS n_rows, round(regr_slope(y, x), 4) AS slope,
  round(regr_intercept(y, x), 4) AS intercept, round(regr_r2(y, x), 6) AS r2, round(avg(y), 4) AS prediction,
  'linear' AS algorithm FROM lines GROUP BY 1""")
def _(spark, sf):
    found = groups.fit_linear_groups(
        roles.table(spark, sf, "lineitem"), ["l_suppkey"], ["l_quantity"], "l_extendedprice"
    )
    return found.select(
        "l_suppkey", "n_rows", F.round(F.col("coefficients")[0], 4).alias("slope"),
        F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"),
        F.round("prediction", 4).alias("prediction"), "algorithm",
    )


MEASURES = ["l_quantity", "l_discount", "l_tax"]


def running_moments(batches):
    """Count, mean and spread of a group's prices, merged from batch to batch."""
    supplier, n, mean, squares = None, 0, 0.0, 0.0
    for batch in batches:
        x = batch["l_extendedprice"].to_numpy()
        supplier, off = batch["l_suppkey"].iloc[0], x.mean() - mean
        squares += ((x - x.mean()) ** 2).sum() + off * off * n * len(x) / (n + len(x))
        mean, n = mean + off * len(x) / (n + len(x)), n + len(x)
    yield pd.DataFrame({"l_suppkey": [supplier], "n_rows": [n], "mean": [mean], "deviation": [(squares / (n - 1)) ** 0.5 if n > 1 else None]})


@query("group_stream", """SELECT l_suppkey, count(*) AS n_rows, round(avg(l_extendedprice), 4) AS mean,
  round(stddev_samp(l_extendedprice), 4) AS deviation FROM lineitem GROUP BY 1""")
def _(spark, sf):
    """A function of pandas batches over each supplier's rows, however many they are."""
    lines = roles.table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    found = groups.map_groups(lines, ["l_suppkey"], running_moments, "l_suppkey bigint, n_rows bigint, mean double, deviation double")
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "deviation")})


@query("group_cross_validation")
def _(spark, sf):
    found = groups.fit_linear_groups(roles.table(spark, sf, "lineitem"), ["l_suppkey"], MEASURES, "l_extendedprice")
    return found.select("l_suppkey", "n_rows", "r2", "cross_validation_metric", "prediction")


@query("group_predict", f"""WITH {LINES}, m AS (SELECT l_suppkey, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
  FROM lines GROUP BY 1)
SELECT l.l_suppkey, count(*) AS n, round(min(a + b * x), 4) AS low, round(max(a + b * x), 4) AS high,
  round(sqrt(avg((y - a - b * x) * (y - a - b * x))), 4) AS rmse FROM lines l JOIN m ON m.l_suppkey = l.l_suppkey GROUP BY 1""")
def _(spark, sf):
    lines = roles.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    models = groups.fit_linear_groups(lines, ["l_suppkey"], ["l_quantity"], "l_extendedprice")
    scored = groups.predict_groups(lines, models, ["l_suppkey"], ["l_quantity"])
    off = F.col("l_extendedprice") - F.col("prediction")
    return scored.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min("prediction"), 4).alias("low"),
        F.round(F.max("prediction"), 4).alias("high"), F.round(F.sqrt(F.avg(off * off)), 4).alias("rmse"),
    )


@query("model_column_predict", f"""WITH {LINES}, m AS (SELECT l_suppkey, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
  FROM lines GROUP BY 1)
SELECT l.l_suppkey, count(*) AS n, round(avg(a + b * x), 4) AS mean FROM lines l JOIN m ON m.l_suppkey = l.l_suppkey GROUP BY 1""")
def _(spark, sf):
    """The stored model bytes, read back and applied as a function of a struct."""
    lines = roles.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    models = groups.fit_linear_groups(lines, ["l_suppkey"], ["l_quantity"], "l_extendedprice")
    scored = lines.join(models.select("l_suppkey", "model_binary"), "l_suppkey", "left").select(
        "l_suppkey", groups.score_model_column("model_binary", F.struct("l_quantity")).alias("p")
    )
    return scored.groupBy("l_suppkey").agg(F.count("p").alias("n"), F.round(F.avg("p"), 4).alias("mean"))


SERIES = """series AS (SELECT o_orderpriority AS grp, o_orderdate AS ds, count(*)::DOUBLE AS y,
  epoch(o_orderdate) / 86400 AS t FROM orders GROUP BY 1, 2),
m AS (SELECT grp, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, max(ds) AS last FROM series GROUP BY 1)"""


def daily_orders(spark, sf):
    return roles.table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("grp"), F.col("o_orderdate").alias("ds")
    ).agg(F.count(F.lit(1)).cast("double").alias("y"))


@query("forecast_trend", f"""WITH {SERIES}, r AS (
  SELECT s.grp, ds, y, a + b * t AS yhat, false AS is_future FROM series s JOIN m ON m.grp = s.grp
  UNION ALL SELECT grp, last + to_days(h), NULL, a + b * (epoch(last) / 86400 + h), true
  FROM m CROSS JOIN (SELECT unnest(range(1, 15))::INTEGER AS h))
SELECT grp, strftime(ds, '%Y-%m-%d') AS ds, y, round(yhat, 6) AS yhat, is_future FROM r""")
def _(spark, sf):
    found = groups.forecast_groups(daily_orders(spark, sf), "grp", horizon=14, periods=())
    return found.select(
        "grp", F.date_format("ds", "yyyy-MM-dd").alias("ds"), "y", F.round("yhat", 6).alias("yhat"), "is_future"
    )


@query("forecast_seasons")
def _(spark, sf):
    return groups.forecast_groups(daily_orders(spark, sf), "grp", horizon=14, periods=((7.0, 2), (365.25, 3)))


@query("newest_models", """SELECT event_type, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY 1""")
def _(spark, sf):
    """The newest row of each kind, as a table of models is read back."""
    rows = roles.table(spark, sf, "events").select("event_type", "event_id", "value", F.col("ts").alias("creation_time"))
    return groups.newest_models(rows, ["event_type"]).select("event_type", "event_id", "value")
