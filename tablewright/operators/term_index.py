"""Cosine search over sparse term weights through bags of words of bounded sides.

A text is a sparse vector: its words, weighted by count and rarity, of unit length. The index holds one row per text, with
its words as 64-bit numbers, their counts, and the square of its length. Texts and queries are dealt into sides of bounded
size. A task holds one side of each and scores all pairs, some queries at a time: words that many texts of the side hold are
multiplied as matrices, the others are added up from their lists of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import as_col
from tablewright.operators.ordered import top_per_group
from tablewright.operators.vectors import each_slot, slot
from tablewright.session import cut_lineage

# letters and digits of any script
WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Text that is cut into words at one time.
TEXT_BYTES = 1 << 22
#: Words whose rarity every task gets; the others' are joined.
HOT_WORDS = 1 << 20
#: Words of texts, or of queries, that a task holds.
SIDE_ROWS = 1 << 21
#: A word is multiplied, not listed, where one text in so many holds it, and as long as the matrix has no more numbers than this.
DENSE_SHARE, DENSE_VALUES = 8, 1 << 22
#: Scores, or products of listed words, that exist at one time.
BLOCK = 1 << 20
DIGITS = 6
#: More than rounding to DIGITS and the order of a sum can change.
SLACK = 2e-6


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(WORD), 0)


def spaced(text: str | Column) -> Column:
    """The same words with one blank between two of them."""
    return F.regexp_replace(F.lower(as_col(text)), F.lit(NOT_WORD), F.lit(" "))


def term_counts(docs: DataFrame, id_name: str, text: str) -> DataFrame:
    """id_name, term, n: the words of each text with their counts."""
    return docs.select(id_name, F.explode(words(text)).alias("term")).groupBy(id_name, "term").agg(F.count(F.lit(1)).alias("n"))


def weighted(counts: DataFrame, stats: DataFrame, id_name: str) -> DataFrame:
    """id_name, term_id, weight, rarity: counts times rarity, of unit length; words that no text of the index has are left out."""
    raw = counts.join(stats.select("term", "term_id", "rarity"), "term").withColumn("raw", F.col("n") * F.col("rarity"))
    norms = raw.groupBy(id_name).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")).where("norm > 0")
    return raw.join(norms, id_name).select(id_name, "term_id", (F.col("raw") / F.col("norm")).alias("weight"), "rarity")


def term_numbers(terms: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number for every word; another seed gives others."""
    return pd.util.hash_array(np.asarray(terms, dtype=object), hash_key=f"{seed:016d}", categorize=False).view(np.int64)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have some megabytes together, or one row."""
    for batch in batches:
        part = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // TEXT_BYTES
        cut = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        yield from (batch.slice(i, j - i) for i, j in zip(cut, cut[1:]) if j > i)


def count_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of spaced texts, each once; places in these and counts of a text's words, text after text; how many each text has."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    # a blank at an end cuts off an empty word
    code += row * len(terms)
    code = code[code % max(len(terms), 1) != pc.index(terms, "").as_py()]
    code.sort()
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    row, at = np.divmod(code[first], max(len(terms), 1))
    n = np.diff(np.append(first, len(code))).astype(np.int32)
    return terms.to_numpy(zero_copy_only=False), at, n, np.bincount(row, minlength=len(texts))


def document_counts(docs: DataFrame, id_name: str, text: str, repeated: bool) -> DataFrame:
    """term, df: how many texts hold each word. Words are counted batch by batch first, if every id stands on one row only."""
    if repeated:
        return term_counts(docs, id_name, text).groupBy("term").agg(F.count(F.lit(1)).alias("df"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms, at, _, _ = count_words(batch.column("text"))
            df = np.bincount(at, minlength=len(terms))
            yield pa.RecordBatch.from_arrays([pa.array(terms[df > 0], pa.string()), pa.array(df[df > 0])], ["term", "df"])

    parts = docs.select(spaced(text).alias("text")).mapInArrow(count, "term string, df long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


def word_stats(counts: DataFrame, texts: int) -> tuple[DataFrame, int, int]:
    """term, term_id, df, rarity of every word, how many words there are, and the seed that tells all of them apart."""
    rarity = F.log((F.lit(texts) + 1) / (F.col("df") + 1))
    counts = cut_lineage(counts.withColumn("rarity", rarity))
    for seed in range(100):
        number = F.pandas_udf(lambda terms, seed=seed: pd.Series(term_numbers(terms, seed)), T.LongType())
        stats = cut_lineage(counts.select("term", number("term").alias("term_id"), "df", "rarity"))
        seen = stats.groupBy("term_id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("words"), F.max("n").alias("most")).first()
        if (seen["most"] or 1) == 1:
            return stats, seen["words"] or 0, seed
    raise RuntimeError("words get the same number under every seed")


def frequent(stats: DataFrame, count: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, in order, and rarities of the words that most texts hold, ``most`` of them at most, by powers of two of these texts."""
    least = 0
    if count > most:
        sizes = stats.groupBy(F.floor(F.log2("df")).alias("size")).agg(F.count(F.lit(1)).alias("n"))
        left = most
        for size, n in sorted(map(tuple, sizes.collect()), reverse=True):
            if n > left:
                least = size + 1
                break
            left -= n
    rows = stats.where(F.floor(F.log2("df")) >= least).select("term_id", "rarity").toArrow()
    numbers, rarities = rows["term_id"].to_numpy(), rows["rarity"].to_numpy()
    by = np.argsort(numbers)
    return numbers[by], rarities[by]


@dataclass(frozen=True)
class TermIndex:
    """Rows (corpus_id, terms, counts, square), several of which may add up to a text, words (term, term_id, df, rarity), and how
    many words all texts hold together. Rows are computed from the texts by every search; persist them for many searches."""

    rows: DataFrame
    terms: DataFrame
    size: int


def lists(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(lengths)).astype(np.int32), pa.array(values))


def build_index(docs: DataFrame, id_name: str = "id", text: str = "content", hot_words: int = HOT_WORDS) -> TermIndex:
    """The index of all words of all texts. A text without words, or null, is not in it."""
    spark = docs.sparkSession
    # a text without words counts too
    seen = docs.groupBy(id_name).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("texts"), F.max("n").alias("most")).first()
    repeated = (seen["most"] or 1) > 1
    stats, count, seed = word_stats(document_counts(docs, id_name, text, repeated), seen["texts"] or 0)
    hot = spark.sparkContext.broadcast(frequent(stats, count, hot_words))
    all_hot = len(hot.value[0]) == count
    kind = docs.schema[id_name].dataType
    bag = [T.StructField(id_name, kind), T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]
    rare = [T.StructField("rare_terms", T.ArrayType(T.LongType())), T.StructField("rare_counts", T.ArrayType(T.IntegerType()))]

    def number(batch: pa.RecordBatch) -> tuple:
        terms, at, n, lengths = count_words(batch.column("text"))
        return batch.column(id_name), term_numbers(terms, seed), at, n, lengths

    def known(batch: pa.RecordBatch) -> tuple:
        terms, at = np.unique(batch.column("terms").flatten().to_numpy(), return_inverse=True)
        n = batch.column("counts").flatten().to_numpy()
        return batch.column(id_name), terms, at, n, pc.list_value_length(batch.column("terms")).to_numpy()

    def measured(ids, terms, at, n, lengths) -> pa.RecordBatch:
        """Adds the square of each text's length, as far as it comes from hot words, and lists the others."""
        numbers, rarities = hot.value
        place = np.minimum(np.searchsorted(numbers, terms), max(len(numbers) - 1, 0))
        found = numbers[place] == terms if len(numbers) else np.zeros(len(terms), bool)
        rarity = np.where(found, rarities[place], 0.0) if len(numbers) else np.zeros(len(terms))
        row = np.repeat(np.arange(len(lengths)), lengths)
        term = terms[at]
        out = [ids, lists(lengths, term), lists(lengths, n)]
        if not all_hot:
            other = ~found[at]
            rare = np.bincount(row[other], minlength=len(lengths))
            out += [lists(rare, term[other]), lists(rare, n[other])]
        out.append(pa.array(np.bincount(row, (n * rarity[at]) ** 2, minlength=len(lengths))))
        return pa.RecordBatch.from_arrays(out, schema.names)

    schema = T.StructType([*bag, *(rare if not all_hot else []), T.StructField("square", T.DoubleType())])
    texts = docs.where(F.col(id_name).isNotNull()).select(id_name, spaced(text).alias("text"))
    if repeated:
        def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, terms, at, n, lengths in map(number, slices(batches)):
                ids = ids.take(pa.array(np.repeat(np.arange(len(lengths)), lengths)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms[at]), pa.array(n)], [id_name, "term_id", "n"])

        found = texts.mapInArrow(bags, T.StructType([bag[0], T.StructField("term_id", T.LongType()), T.StructField("n", T.IntegerType())]))
        found = found.groupBy(id_name, "term_id").agg(F.sum("n").cast("int").alias("n"))
        found = found.groupBy(id_name).agg(F.collect_list(F.struct("term_id", "n")).alias("bag"))
        found = found.select(id_name, F.col("bag.term_id").alias("terms"), F.col("bag.n").alias("counts"))
        rows = found.mapInArrow(lambda batches: (measured(*known(b)) for b in batches), schema)
    else:
        rows = texts.mapInArrow(lambda batches: (measured(*number(b)) for b in slices(batches)), schema)
    rows = rows.where(F.size("terms") > 0).withColumnRenamed(id_name, "corpus_id")
    kept = rows.select("corpus_id", "terms", "counts", "square")
    if not all_hot:
        listed = rows.select("corpus_id", F.explode(F.arrays_zip("rare_terms", "rare_counts")).alias("x"))
        raw = listed.select("corpus_id", F.col("x.rare_terms").alias("term_id"), F.col("x.rare_counts").alias("n"))
        raw = raw.join(stats.select("term_id", "rarity"), "term_id").withColumn("raw", F.col("n") * F.col("rarity"))
        squares = cut_lineage(raw.groupBy("corpus_id").agg(F.sum(F.col("raw") * F.col("raw")).alias("square")))
        none = [F.array().cast(kept.schema[c].dataType).alias(c) for c in ("terms", "counts")]
        kept = kept.unionByName(squares.select("corpus_id", *none, "square"))
    return TermIndex(kept, stats, stats.agg(F.sum("df")).first()[0] or 0)


def flat(column: pd.Series, kind) -> np.ndarray:
    return np.concatenate([*column, np.empty(0, kind)]).astype(kind, copy=False)


def best_in_sides(queries: pd.DataFrame, corpus: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best texts of a side for each query of a side: query_id, corpus_id, score; equal scores by id.

    ``queries`` holds a row per query (query_id, terms, shares), ``corpus`` rows (corpus_id, terms, counts, square).
    """
    none = pd.DataFrame({"query_id": [], "corpus_id": [], "score": []})
    if queries.empty or corpus.empty:
        return none
    ids, row = np.unique(corpus["corpus_id"].to_numpy(), return_inverse=True)
    length = np.sqrt(np.bincount(row, corpus["square"].to_numpy()))
    measured = length > 0
    length[~measured] = 1.0
    asked = flat(queries["terms"], np.int64)
    known, asked = np.unique(asked, return_inverse=True)
    share = flat(queries["shares"], np.float64)
    first = np.append(0, np.cumsum(np.fromiter(map(len, queries["terms"]), np.int64, len(queries))))
    # words that no query asks for are left out, and texts without length
    term = flat(corpus["terms"], np.int64)
    text = np.repeat(row, np.fromiter(map(len, corpus["terms"]), np.int64, len(corpus))).astype(np.int32)
    at = np.minimum(np.searchsorted(known, term), len(known) - 1).astype(np.int32)
    held = (known[at] == term) & measured[text] if len(known) else np.zeros(len(term), bool)
    del term
    at, text, n = at[held], text[held], flat(corpus["counts"], np.int32)[held]
    by = np.argsort(at, kind="stable")
    at, text, n = at[by], text[by], n[by]
    del by, held
    start = np.searchsorted(at, np.arange(len(known) + 1))
    size = np.diff(start)
    texts = len(ids)
    common = np.argsort(-size, kind="stable")[: max(1, DENSE_VALUES // texts)]
    common = common[size[common] * DENSE_SHARE >= texts]
    column = np.full(len(known), -1)
    column[common] = np.arange(len(common))
    matrix = np.zeros((len(common), texts))
    for i, w in enumerate(common):
        matrix[i, text[start[w] : start[w + 1]]] = n[start[w] : start[w + 1]]

    groups = texts // max(8, min(64, texts // (8 * k)))
    width = texts // groups if groups else 0
    step = max(1, BLOCK // texts)
    out_query, out_text, out_score = [], [], []
    for i in range(0, len(queries), step):
        j = min(i + step, len(queries))
        word, part = asked[first[i] : first[j]], share[first[i] : first[j]]
        line = np.repeat(np.arange(j - i), np.diff(first[i : j + 1]))
        dense = column[word] >= 0
        left = np.zeros((j - i, len(common)))
        left[line[dense], column[word[dense]]] = part[dense]
        score = left @ matrix
        flat_score = score.reshape(-1)
        listed = np.flatnonzero(~dense & (size[word] > 0))
        done = np.cumsum(size[word[listed]])
        while len(listed):
            some = max(1, int(np.searchsorted(done, BLOCK, side="right")))
            w, now = word[listed[:some]], done[:some]
            place = np.repeat(start[w] - (now - size[w]), size[w]) + np.arange(now[-1])
            cell = np.repeat(line[listed[:some]] * texts, size[w]) + text[place]
            value = np.repeat(part[listed[:some]], size[w]) * n[place]
            if len(cell) * 8 > len(flat_score):
                flat_score += np.bincount(cell, value, minlength=len(flat_score))
            else:
                np.add.at(flat_score, cell, value)
            listed, done = listed[some:], done[some:] - now[-1]
        score /= length
        # the k-th largest of the groups' largest scores is no more than the k-th largest score
        if groups >= k:
            top = score[:, : groups * width].reshape(j - i, groups, width).max(axis=2)
            floor = np.partition(top, groups - k, axis=1)[:, groups - k]
        elif texts > k:
            floor = np.partition(score, texts - k, axis=1)[:, texts - k]
        else:
            floor = np.zeros(j - i)
        # with fewer than k texts above nothing, all that hold a word are found: a word of all texts weighs nothing
        few = floor <= SLACK
        r, c = np.nonzero(score >= np.where(few, np.inf, floor - SLACK)[:, None])
        for one in np.flatnonzero(few):
            reach = np.unique(np.concatenate([text[start[w] : start[w + 1]] for w in word[line == one]] + [text[:0]]))
            r, c = np.append(r, np.full(len(reach), one)), np.append(c, reach)
        value = np.round(score[r, c], DIGITS)
        by = np.lexsort((c, -value, r))
        r, c, value = r[by], c[by], value[by]
        best = np.arange(len(r)) - np.searchsorted(r, r, side="left") < k
        out_query.append(r[best] + i)
        out_text.append(c[best])
        out_score.append(value[best])
    query, found = np.concatenate(out_query), np.concatenate(out_text)
    if not len(query):
        return none
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[query], "corpus_id": ids[found], "score": np.concatenate(out_score)})


def best_matches(
    queries: DataFrame, index: TermIndex, k: int, id_name: str = "id", text: str = "question", side_rows: int = SIDE_ROWS
) -> DataFrame:
    """Exact top-k by cosine: query_id, rank, corpus_id, score, equal scores by id.

    Only texts that share a word with the query are found, so a query may have fewer than k, or none.
    """
    # a text's weight is its count times the word's rarity over its length; the rarity comes with the query
    words_asked = weighted(term_counts(queries, id_name, text), index.terms, id_name)
    parts = F.collect_list(F.struct("term_id", (F.col("weight") * F.col("rarity")).alias("share")))
    asked = cut_lineage(words_asked.groupBy(F.col(id_name).alias("query_id")).agg(parts.alias("x")).select(
        "query_id", F.col("x.term_id").alias("terms"), F.col("x.share").alias("shares")
    ))
    text_sides = max(1, math.ceil(index.size / side_rows))
    cores = queries.sparkSession.sparkContext.defaultParallelism
    query_words = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    query_sides = max(1, math.ceil(query_words / side_rows), math.ceil(2 * cores / text_sides))
    pairs = text_sides * query_sides
    # pairs are small but slow, so they must not be coalesced by size; spare partitions keep two of them apart
    tasks = max(pairs, min(4 * pairs, 8 * cores))
    left = asked.select("*", slot("query_id", query_sides).alias("a"), each_slot(text_sides).alias("t")).repartition(tasks, "a", "t")
    right = index.rows.select("*", slot("corpus_id", text_sides).alias("t"), each_slot(query_sides).alias("a")).repartition(tasks, "a", "t")
    schema = T.StructType([
        T.StructField("query_id", asked.schema["query_id"].dataType),
        T.StructField("corpus_id", index.rows.schema["corpus_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    found = left.groupBy("a", "t").cogroup(right.groupBy("a", "t")).applyInPandas(lambda a, b: best_in_sides(a, b, k), schema)
    return top_per_group(found, ["query_id"], [F.desc("score"), "corpus_id"], k).select("query_id", "rank", "corpus_id", "score")
