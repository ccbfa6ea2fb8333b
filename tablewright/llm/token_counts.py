"""Token counts by separator scan over flat token files without an index.

A token file is a row of little-endian 16-bit ids, each document followed by an end-of-document id. Blocks of the files
are searched for that id with vector operations, and a prefix scan over the blocks' summaries stitches the documents
that cross block boundaries.
"""

from __future__ import annotations

import base64
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import col, make_rows, store
from tablewright.session import cut_lineage, scratch_path

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that splits texts before the vocabulary's merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The first id that the vocabulary leaves free.
END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 2**21
#: Blocks whose summaries are scanned in one window; their totals are scanned one level up.
RUN = 1024
MAX_FILE_BYTES = 512 * 2**20


def load_vocabulary(folder: str = TOKENIZERS, name: str = VOCABULARY) -> dict[bytes, int]:
    """Ranks of the tokens."""
    with open(os.path.join(folder, name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_tokens(docs: DataFrame, folder: str, tokenizers: str = TOKENIZERS, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Write the documents' ids as flat files under ``folder``: path, ordinal, doc_id, and rows with ordinal -1 and a file's length.

    Null and empty texts are a lone separator. An attempt writes under names of its own, and only files of attempts that
    succeeded are in the result. The vocabulary (under 1 MB) is sent to the tasks.
    """
    held = docs.sparkSession.sparkContext.broadcast(load_vocabulary(tokenizers))

    def work(batches):
        fs, top = store(folder)
        fs.create_dir(top, recursive=True)
        encode = encoder(held.value).encode_ordinary
        out, path, n = None, "", 0
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                if out is None:
                    path, n = f"{top}/{uuid.uuid4().hex}.bin", 0
                    out = fs.open_output_stream(path, compression=None)
                out.write(np.array([*encode(text or ""), END_OF_DOCUMENT], dtype="<u2").tobytes())
                rows.append((path, n, doc_id, None))
                n += 1
                if out.tell() >= max_bytes:
                    rows.append((path, -1, None, out.tell()))
                    out.close()
                    out = None
            if rows:
                yield [list(c) for c in zip(*rows, strict=True)]
        if out is not None:
            length = out.tell()
            out.close()
            yield [[path], [-1], [None], [length]]

    kinds = [("path", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.string()), ("length", pa.int64())]
    return cut_lineage(make_rows(docs.select(col("doc_id").cast("string"), col("text").cast("string")), kinds, work))


def separators(files: DataFrame, folder: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """path, block, size, ends: the places in each block of the files (path, length) that hold the separator."""
    step = 2 * block_tokens
    blocks = files.where("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))).alias("offset")
    )

    def work(batches):
        fs, _ = store(folder)
        for paths, lengths, offsets in batches:
            for path, length, offset in zip(paths, lengths, offsets, strict=True):
                with fs.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(min(step, length - offset), offset), dtype="<u2")
                yield [[path], [offset // step], [len(ids)], [np.flatnonzero(ids == end).tolist()]]

    kinds = [("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int32()))]
    return make_rows(blocks.repartition("path", "offset"), kinds, work)


def document_lengths(files: DataFrame, folder: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """path, ordinal, start, n_tokens, closed for each document of the files (path, length); separators are not counted.

    What follows a file's last separator is a document that is not closed. Empty files have no documents.
    """
    found = cut_lineage(separators(files, folder, end, block_tokens))
    first = F.col("block") * block_tokens
    marks = found.select(
        "path", "block", F.floor(F.col("block") / RUN).alias("run"), first.alias("first"), F.size("ends").cast("long").alias("n"),
        (first + F.array_max("ends")).alias("last"), (first + F.col("size")).alias("until"),
    )
    upper = Window.partitionBy("path").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = marks.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "path", "run", F.sum("n").over(upper).alias("n_before_run"), F.max("last").over(upper).alias("last_before_run")
    )
    inner = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = marks.select(
        "path", "run", "block", F.sum("n").over(inner).alias("n_before"), F.max("last").over(inner).alias("last_before")
    ).join(runs, ["path", "run"]).select(
        "path", "block", (F.coalesce("n_before", F.lit(0)) + F.coalesce("n_before_run", F.lit(0))).alias("base"),
        (F.coalesce("last_before", "last_before_run", F.lit(-1)) + 1).alias("open"),
    )
    placed = found.join(scanned, ["path", "block"])
    # each end comes with the one before it, so that the exploded rows need not carry the block's array
    ends = F.transform("ends", lambda at, k: F.struct(at.alias("at"), F.get("ends", k - 1).alias("before")))
    rows = placed.select("path", "base", "open", first.alias("first"), F.posexplode(ends).alias("k", "e"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("first") + F.col("e.before") + 1)
    closed = rows.select(
        "path", (F.col("base") + F.col("k")).alias("ordinal"), start.alias("start"),
        (F.col("first") + F.col("e.at") - start).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    whole = marks.groupBy("path").agg(
        F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.max("until").alias("until")
    )
    tail = whole.where("until > start").select(
        "path", "ordinal", "start", (F.col("until") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(tail)


def token_counts(docs: DataFrame, folder: str | None = None, tokenizers: str = TOKENIZERS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_tokens: the documents written as token files and counted by scanning these.

    Every row stays, repeated ones and those without an id too. Null and empty texts have no tokens. Ids may have any
    type that casts to text and back. An empty table writes no files and gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    manifest = write_tokens(docs, folder, tokenizers)
    files = manifest.where("ordinal = -1").select("path", "length")
    counted = document_lengths(files, folder, block_tokens=block_tokens)
    return manifest.where("ordinal >= 0").select("path", "ordinal", "doc_id").join(
        counted.select("path", "ordinal", "n_tokens"), ["path", "ordinal"]
    ).select(F.col("doc_id").cast(docs.select(col("doc_id")).schema[0].dataType), "n_tokens")
