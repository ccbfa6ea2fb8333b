"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Every text is measured (words, symbols, repeated lines and windows). Each rule rejects a text whose measure lies above a
cutoff. The cutoffs of all rules get stricter together, one rule's cutoff at each step, and a step rejects all that the one
before it does. Labelled good documents decide how far a stratum goes: steps are tested in this fixed sequence, each at
the stratum's full level, by the exact binomial tail of all rules' false rejections together, and the first that fails ends
it. So no level is spent on the number of steps or rules, and the levels of all strata sum up to DELTA. A stratum with too
few good labels to pass any test shares one test with the others that have too few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import SPACE, WORD, col, fresh
from tablewright.session import cut_lineage

REPEAT_WINDOW = 8
#: Measures that rules are about; the higher, the worse.
RULES = ("symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share")
#: Cutoffs that are tried for each rule, from lenient to strict.
CUTOFFS = tuple(0.6 * 0.85**j for j in range(24))
#: All rules together reject at most RISK of the good documents of a stratum, but for a chance of DELTA.
RISK = 0.02
DELTA = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _kept_chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its measures, and their column names by role: the counts, RULES and base_failed.

    Null and empty texts have no words, count 0 everywhere and fail the base rules. A window's words are compared by
    64-bit hashes within one text.
    """
    roles = (*COUNTS, *RULES, "base_failed")
    names = dict(zip(roles, fresh(docs, *roles), strict=True))
    body, words, windows, order, starts, lines, upper, marks = fresh(
        docs, "body", "words", "windows", "order", "starts", "lines", "upper", "marks"
    )
    n = REPEAT_WINDOW
    df = docs.withColumn(body, F.coalesce(col(text).cast("string"), F.lit("")))
    df = df.withColumns({
        words: F.transform(F.filter(F.split(col(body), SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)),
        lines: F.filter(F.split(col(body), "\n"), lambda x: x.rlike(WORD)),
        names["word_chars"]: _kept_chars(col(body), SPACE),
        names["n_symbols"]: _kept_chars(col(body), r"[^#*$%&|<>]+"),
        upper: _kept_chars(col(body), "[^A-Z]+"),
        marks: _kept_chars(col(body), "[^!?]+"),
    }).drop(body)
    df = df.withColumns({
        windows: F.when(
            F.size(col(words)) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(col(words)) - n),
                lambda i: F.xxhash64(*(F.get(col(words), i + k) for k in range(n))),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
        names["n_words"]: F.size(col(words)).cast("long"),
        names["n_dup_lines"]: (F.size(col(lines)) - F.size(F.array_distinct(col(lines)))).cast("long"),
        names["dup_line_share"]: _share(F.size(col(lines)) - F.size(F.array_distinct(col(lines))), F.size(col(lines))),
    }).drop(words, lines)
    # only texts with a repeated window are sorted
    df = df.withColumn(
        order,
        F.when(
            F.size(F.array_distinct(col(windows))) < F.size(col(windows)),
            F.sort_array(F.transform(col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop(windows)
    df = df.withColumn(
        starts,
        F.sort_array(F.transform(
            F.filter(
                col(order),
                lambda e, j: _same(e, F.get(col(order), j - 1)) | _same(e, F.get(col(order), j + 1)),
            ),
            lambda e: e["i"],
        )),
    ).drop(order)
    gaps = F.transform(col(starts), lambda x, j: F.least(F.lit(n), F.coalesce(F.get(col(starts), j + 1) - x, F.lit(n))))
    df = df.withColumn(names["n_repeat_words"], F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)).drop(starts)
    n_words, chars = col(names["n_words"]), col(names["word_chars"])
    return df.withColumns({
        names["symbol_share"]: _share(col(names["n_symbols"]), chars),
        names["upper_share"]: _share(col(upper), chars),
        names["mark_share"]: _share(col(marks), chars),
        names["repeat_share"]: _share(col(names["n_repeat_words"]), n_words),
        names["base_failed"]: (n_words < 20) | (100 * col(names["n_repeat_words"]) > 30 * n_words),
    }).drop(upper, marks), names


def _same(a: Column, b: Column) -> Column:
    return F.coalesce(a["h"] == b["h"], F.lit(False))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def stratum(lang: Column) -> Column:
    """The language code, or the empty string for anything but two or three small letters, so that there are at most 18,253."""
    return F.when(lang.rlike("^[a-z]{2,3}$"), lang).otherwise("")


def tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, risk), summed term by term in logarithms; 1 where k is not below the mean."""
    odds, none = math.log(risk / (1 - risk)), n * math.log1p(-risk)
    first = F.struct(none.alias("lt"), F.exp(none).alias("total"))

    def step(acc, i):
        lt = acc["lt"] + F.log((n - i + 1) / i) + odds
        return F.struct(lt.alias("lt"), (acc["total"] + F.exp(lt)).alias("total"))

    added = F.aggregate(F.sequence(F.lit(1).cast("long"), k), first, step, lambda acc: acc["total"])
    return F.when(k >= n * risk, 1.0).when(k == 0, F.exp(none)).otherwise(added)


def first_step(values: list[Column]) -> Column:
    """The first step that rejects these measures, step j * rules + i cutting rule i at CUTOFFS[j]; null for none."""
    cuts = F.array(*(F.lit(c) for c in CUTOFFS))
    above = lambda v: F.size(F.filter(cuts, lambda c: v > c))
    # a value above the last n cutoffs is rejected from the n-th last on
    at = [above(v) for v in values]
    found = [F.when(n > 0, (len(CUTOFFS) - n) * len(values) + i) for i, n in enumerate(at)]
    return F.least(*found) if len(found) > 1 else found[0]


def cutoff_table(labelled: DataFrame, rules: tuple[str, ...] = RULES, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The step each stratum goes to: stratum, pooled, step, limits (rule to cutoff), n_good, n_bad, good_out, bad_out, bound.

    ``labelled`` has stratum, good (boolean) and the rules' measures, one row per labelled document. Of the steps that pass
    that one is taken which rejects the most bad documents beyond the good ones, and the most lenient among equals. Strata
    with fewer good labels than a test without any false rejection needs are tested together, as ``pooled``; where this
    is too few as well there is no step. Rows are counted by stratum and step first, so a hot stratum is 121 rows a task.
    """
    counts = cut_lineage(
        labelled.select("stratum", "good", first_step([col(r) for r in rules]).alias("step")).groupBy("stratum", "step")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    sizes = counts.groupBy("stratum").agg(F.sum("good").alias("n"))
    level = delta / max(1, sizes.count())
    sizes = sizes.withColumn("pooled", F.col("n") < math.ceil(math.log(level) / math.log1p(-risk)))
    tested = F.when(F.col("pooled"), "").otherwise(F.col("stratum")).alias("tested")
    members = sizes.select("stratum", "pooled", tested)
    whole = Window.partitionBy("tested", "pooled")
    upto = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a step at which nothing more is rejected passes with the one before it
    steps = (
        counts.join(members, "stratum").groupBy("tested", "pooled", "step").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .withColumns({"n_good": F.sum("good").over(whole), "n_bad": F.sum("bad").over(whole)}).where(F.col("step").isNotNull())
        .withColumns({"good_out": F.sum("good").over(upto), "bad_out": F.sum("bad").over(upto)}).drop("good", "bad")
        .withColumn("bound", tail(F.col("n_good"), F.col("good_out"), risk))
    )
    passed = F.max(F.when(F.col("bound") > level, 1).otherwise(0)).over(upto) == 0
    gain = F.col("bad_out") - F.col("good_out")
    fields = ["step", "n_good", "n_bad", "good_out", "bad_out", "bound"]
    best = F.max_by(F.struct(*fields), F.struct(gain, -F.col("step")))
    taken = steps.withColumn("passed", passed).where(F.col("passed") & (gain > 0)).groupBy("tested", "pooled").agg(best.alias("b"))
    cuts = F.array(*(F.lit(c) for c in CUTOFFS))
    last = [F.floor((F.col("step") - i) / len(rules)).cast("int") for i in range(len(rules))]
    limits = F.array(*(F.struct(F.lit(r).alias("rule"), F.get(cuts, j).alias("cutoff")) for r, j in zip(rules, last, strict=True)))
    return members.join(taken, ["tested", "pooled"]).select("stratum", "pooled", "b.*").withColumn(
        "limits", F.map_from_entries(F.filter(limits, lambda e: e["cutoff"].isNotNull()))
    )


def labelled_good(labels: DataFrame) -> DataFrame:
    """One row per labelled document: label_id, good. Where its labels disagree, a document counts as good."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id")).agg((F.max("quality") == 1).alias("good"))
    )


def judge(measures: DataFrame, cutoffs: DataFrame, names: dict[str, str], lang: str = "lang") -> tuple[DataFrame, str]:
    """``measures`` with a column that is true for documents to keep, and its name.

    The cutoffs are at most one row for each of the 18,253 strata, so they are broadcast.
    """
    key, limits, kept = fresh(measures, "stratum_key", "limits", "kept")
    of = cutoffs.select(F.col("stratum").alias(key), F.col("limits").alias(limits))
    joined = measures.withColumn(key, stratum(col(lang))).join(F.broadcast(of), key, "left")
    over = [F.coalesce(col(names[r]) > F.try_element_at(col(limits), F.lit(r)), F.lit(False)) for r in RULES]
    bad = col(names["base_failed"])
    for x in over:
        bad = bad | x
    return joined.withColumn(kept, ~bad).drop(key, limits), kept


def _learned(measures: DataFrame, labels: DataFrame, names: dict[str, str]) -> DataFrame:
    """Cutoffs from the labelled documents that the base rules pass."""
    rows = measures.where(~col(names["base_failed"])).select(
        col("doc_id").alias("label_id"), stratum(col("lang")).alias("stratum"), *(col(names[r]).alias(r) for r in RULES)
    )
    return cutoff_table(rows.join(labelled_good(labels), "label_id"))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept. Every row stays, repeated ones and null ids too.

    Without labels no step passes and only the base rules decide.
    """
    found, names = measured(docs.select("doc_id", "text", "lang"))
    rows = cut_lineage(found.drop("text"))
    judged, kept = judge(rows, _learned(rows, labels, names), names)
    return judged.select("doc_id", *(col(names[c]).alias(c) for c in (*COUNTS, "base_failed")), col(kept).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``assess`` keeps, with their own columns only.

    The verdicts are written out by id and a hash of text and language, and meet the documents by these; a filter on the
    measures themselves would be pushed below them and work them out again for every reference.
    """
    at, key = fresh(docs, "kept_id", "kept_key")
    same = F.xxhash64(F.coalesce(col("text").cast("string"), F.lit("")), F.coalesce(col("lang"), F.lit("")))
    found, names = measured(docs.select("doc_id", "text", "lang").withColumn(key, same))
    rows = cut_lineage(found.drop("text"))
    judged, kept = judge(rows, _learned(rows, labels, names), names)
    wanted = judged.where(col(kept)).select(col("doc_id").alias(at), col(key))
    keyed = docs.withColumn(key, same).alias("d")
    wanted = wanted.select(col(at), col(key).alias(f"{key}_"))
    out = keyed.join(wanted, col("doc_id").eqNullSafe(col(at)) & (col(key) == col(f"{key}_")), "left_semi")
    return out.drop(key)
