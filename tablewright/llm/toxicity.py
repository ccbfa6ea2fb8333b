"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, hashed into buckets with an embedding each, so misspellings share most of
their vectors with the word they stand for. The words of a span are averaged and scored by a softmax over two classes; a
document is as toxic as its most toxic span, so that a few words count in a long text as much as in a short one.

Labels belong to documents. Training starts from spans that all carry their document's label and moves on to the likeliest
spans of each document, for toxic and clean documents alike, while embeddings and softmax weights are fitted together.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, chunks, col, make_rows, mixed

BUCKETS = 2**17
DIM = 12
#: Words of a span. One was best on labels of training rows (1, 3 and 6 were tried); longer spans dilute misspelt words.
SPAN = 1
SIZES = (3, 4, 5)
#: Words of more than LONG characters are cut into pieces of PIECE characters, one each STEP characters, and at ASCII punctuation.
LONG, PIECE, STEP = 64, 16, 8
#: Characters of words whose n-grams are held at a time when texts are scored.
AT_ONCE = 2_000_000
#: The training sample: at most so many labelled documents of each class, by hash, of texts up to so many characters.
MAX_PER_CLASS = 1000
MAX_CHARS = 20_000
EPOCHS = 40
#: Step size, weight decay, and the slope below which steps shrink, so that chance n-grams stay small.
RATE, DECAY, FLOOR = 0.05, 0.3, 1e-5
SEED = 7

_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_BLANKS = str.maketrans(_STRIP, " " * len(_STRIP))


def words(text: str | None) -> list[str]:
    """Words between white space in small letters, without ASCII punctuation around them; long ones as their pieces."""
    out = []
    for x in (text or "").lower().split():
        if w := x.strip(_STRIP):
            if len(w) > LONG:
                out += pieces(w)
            else:
                out.append(w)
    return out


def pieces(word: str) -> list[str]:
    """Overlapping pieces that have all n-grams of a long word, and its parts between ASCII punctuation where it has any."""
    out = [word[i : i + PIECE] for i in range(0, len(word) - PIECE + STEP, STEP)]
    parts = [p for p in word.translate(_BLANKS).split() if len(p) <= LONG]
    return out + parts


def ngrams(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams in a row, boundaries marked, and where each word's begin. Every word has one at least."""
    marked = [f"<{w}>" for w in vocabulary]
    lengths = np.array([len(w) for w in marked], dtype=np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(marked)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the word's end
    owners, found = [], []
    for n in SIZES:
        rolled = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x100000001B3) + codes[k : k + len(rolled)]
        at = np.flatnonzero(left[: len(rolled)] >= n)
        owners.append(word[at])
        found.append((mixed(rolled[at] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64))
    owner, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(marked) + 1))
    return bucket[order], starts


def means(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means of runs of rows; every run has a row."""
    return np.add.reduceat(values, starts[:-1], axis=0) / np.diff(starts).astype(np.float32).reshape(-1, *[1] * (values.ndim - 1))


@dataclass
class Model:
    embeddings: np.ndarray  # dimension by bucket
    weights: np.ndarray  # dimension by class
    bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def bucket_scores(self) -> np.ndarray:
        """Each bucket's part of the difference between the classes' scores: averages are linear in it."""
        return ((self.weights[:, 1] - self.weights[:, 0]) @ self.embeddings).astype(np.float32)


class Corpus:
    """Documents as word numbers and spans."""

    def __init__(self, texts: list[str | None]):
        lists = [words(t) for t in texts]
        flat = np.empty(sum(map(len, lists)), dtype=object)
        flat[:] = [w for x in lists for w in x]
        self.ids, vocabulary = pd.factorize(flat)
        self.vocabulary = list(vocabulary)
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        spans = -(-counts // SPAN)
        self.doc_spans = np.concatenate([[0], np.cumsum(spans)])
        base = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), spans)
        place = np.arange(self.doc_spans[-1]) - np.repeat(self.doc_spans[:-1], spans)
        self.starts = np.append(base + place * SPAN, len(flat)).astype(np.int64)
        self.doc = np.repeat(np.arange(len(lists)), spans)

    def span_scores(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.empty(0, np.float32)
        ends = np.cumsum([len(w) for w in self.vocabulary])
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + AT_ONCE, AT_ONCE)))
        parts = []
        for a, b in zip(cuts, [*cuts[1:], len(ends)], strict=True):
            if a < b:
                grams, at = ngrams(self.vocabulary[a:b])
                parts.append(means(buckets[grams], at))
        return means(np.concatenate(parts)[self.ids], self.starts)

    def top(self, spans: np.ndarray, empty: float) -> np.ndarray:
        out = np.full(len(self.doc_spans) - 1, empty)
        full = np.flatnonzero(np.diff(self.doc_spans))
        if len(full):
            out[full] = np.maximum.reduceat(spans, self.doc_spans[:-1][full])
        return out


def train(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit embeddings, weights and the calibration of the top span's score. Without both labels, scores are the label's share."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.int64)
    model = Model(rng.normal(0, 0.1, (DIM, BUCKETS)).astype(np.float32), rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32))
    share = float(labels.mean()) if len(labels) else 0.0
    corpus = Corpus(texts) if 0 < share < 1 else None
    if corpus is None or not len(corpus.ids):
        model.embeddings[:] = 0
        model.shift = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return model
    grams, at = ngrams(corpus.vocabulary)
    n_docs, spans_of = len(texts), np.diff(corpus.doc_spans)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.embeddings, model.weights, model.bias)]
    weight_of = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))  # both classes weigh the same
    for epoch in range(epochs):
        score = means(means(model.bucket_scores()[grams], at)[corpus.ids], corpus.starts)
        # from all spans alike to the likeliest ones
        sharp = 8.0 * min(1.0, max(0.0, (epoch - 5) / (0.4 * epochs)))
        top = corpus.top(score, 0.0)
        pull = np.exp(sharp * (score - top[corpus.doc]))
        pull /= np.bincount(corpus.doc, pull, minlength=n_docs)[corpus.doc]
        used = np.flatnonzero(pull > 0.02 / max(1, np.median(spans_of)))
        weight = pull[used] * weight_of[corpus.doc[used]]
        lengths = np.diff(corpus.starts)[used]
        inside = np.repeat(corpus.starts[used] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        vocab, local = np.unique(corpus.ids[inside], return_inverse=True)
        sizes = np.diff(at)[vocab]
        gram = grams[np.repeat(at[vocab] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        vectors = np.stack([means(row[gram], ends) for row in model.embeddings], axis=1)
        span_starts = np.concatenate([[0], np.cumsum(lengths)])
        x = means(vectors[local], span_starts)
        z = x @ model.weights + model.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = ((p - np.eye(2, dtype=np.float32)[labels[corpus.doc[used]]]) * weight[:, None] / n_docs).astype(np.float32)
        to_span = error @ model.weights.T / lengths[:, None].astype(np.float32)
        spread = np.repeat(to_span, lengths, axis=0)
        slope = np.zeros_like(model.embeddings)  # row by row, as all n-grams times all dimensions would not fit
        for d in range(DIM):
            to_word = np.bincount(local, spread[:, d], minlength=len(vocab)) / sizes
            slope[d] = np.bincount(gram, np.repeat(to_word, sizes), minlength=BUCKETS)
        for value, grad, (m, v) in zip(
            (model.embeddings, model.weights, model.bias), (slope, x.T @ error, error.sum(axis=0)), moments, strict=True
        ):
            m += 0.1 * (grad - m)
            v += 0.02 * (grad * grad - v)
            value *= 1 - RATE * DECAY
            value -= RATE * (m / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(v / (1 - 0.98 ** (epoch + 1))) + FLOOR)
    top = corpus.top(corpus.span_scores(model.bucket_scores()), -20.0) + model.bias[1] - model.bias[0]
    model.scale, model.shift = calibrated(top, labels)
    return model


def calibrated(top: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the top scores: the cut with fewest errors gets 0.5."""
    order = np.argsort(top)
    y = labels[order]
    errors = np.concatenate([[len(y) - y.sum()], (len(y) - y.sum()) + np.cumsum(2 * y - 1)])
    best = np.flatnonzero(errors == errors.min())
    k = best[len(best) // 2]
    x = top[order]
    cut = (x[max(0, k - 1)] + x[min(len(x) - 1, k)]) / 2
    gap = max(1e-3, float(np.median(x[y == 1]) - np.median(x[y == 0])))
    return 6 / gap, -6 / gap * cut


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, max_chars: int = MAX_CHARS, seed: int = SEED) -> Model:
    """Train on a sample of the labelled documents that are not held out.

    Of each class the ``max_per_class`` documents that come first by hash take part, but for texts of more than
    ``max_chars`` characters; so the sample stays under 60 million characters whatever the tables' size. Rows without an
    id or label do not take part; of rows with one id the least by text hash does, and the greatest of its labels.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max("toxic").alias("toxic")
    ).where(~held_out(F.col("label_id")))
    order = F.xxhash64(F.lit(seed), "label_id")
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "label_id").limit(max_per_class) for c in (0, 1)]
    # ids alone are sorted; at most 2 * max_per_class of them meet the texts
    sample = docs.select(col("doc_id"), col("text").cast("string").alias("text")).where(F.length("text") <= max_chars).join(
        F.broadcast(chosen[0].unionByName(chosen[1])), F.col("doc_id") == F.col("label_id")
    ).groupBy("label_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")).orderBy(order, "label_id").limit(2 * max_per_class)

    def work(batches):
        texts, toxic = [], []
        for columns in batches:
            texts += columns[0]
            toxic += columns[1]
        m = train(texts, np.array(toxic, dtype=np.int64), seed=seed)
        yield [[pickle.dumps((m.embeddings, m.weights, m.bias, m.scale, m.shift))]]

    # one task reads the bounded sample and gives back the model, 6 MB
    row = make_rows(sample.select("text", "toxic").coalesce(1), [("model", pa.binary())], work).first()
    return Model(*pickle.loads(row["model"])) if row else train([], np.empty(0, np.int64))


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training: crc32 of its id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null and empty texts get the score of no span; every row stays.

    The tasks get one number per bucket, 0.5 MB.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.bucket_scores(), float(model.bias[1] - model.bias[0]), model.scale, model.shift))

    def make():
        buckets, bias, scale, shift = held.value

        def work(texts):
            out = []
            for a, b in chunks(texts):
                corpus = Corpus(texts[a:b])
                z = scale * (corpus.top(corpus.span_scores(buckets), -20.0) + bias) + shift
                out += (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()
            return [out]

        return work

    rows = docs.select(col("doc_id"), col("text").cast("string").alias("text"))
    out = add_columns(rows, ["text"], [("score", pa.float64())], make)
    return out.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every document."""
    return scores(docs, fit(docs, labels))
