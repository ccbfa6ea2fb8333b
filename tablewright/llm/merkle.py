"""A Merkle manifest of a dataset: leaves by source, subtrees in van Emde Boas order, proofs and their verification.

Each source has a tree whose inner nodes hash runs of FANOUT nodes, and one more tree holds the sources' roots. A tree is
cut into aligned blocks of LEVELS levels of runs, FANOUT ** LEVELS leaves each, however many rows a source has. A block is
one array of digests: its upper half of levels first, then the lower subtrees from left to right, each halved again in
the same way. Arithmetic alone gives the address of a node, for construction and to fetch the siblings of a path. The roots
of the blocks are the leaves of the next blocks, until a tree has one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import add_columns, col
from tablewright.session import cut_lineage

FANOUT = 16
#: Levels of runs in a block.
LEVELS = 3
#: Bytes of a stored digest.
WIDTH = 32
_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index of a partition in its low 33 bits


def encoded(value: Column) -> Column:
    """A value as the tree hashes it: its bytes' count, a colon and the value, or a minus for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*(encoded(v) for v in values)).cast("binary"), 256)


def nodes(levels: int) -> int:
    """Nodes of a complete subtree with this many levels of nodes."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where a complete subtree with ``levels`` levels of nodes keeps the nodes at this depth, the root being 0."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(depth, index, upper)
    spread = FANOUT ** (depth - upper)
    below = address(depth - upper, index % spread, levels - upper)
    return nodes(upper) + (index // spread) * nodes(levels - upper) + below


def parent_of(children: bytes) -> bytes:
    return hashlib.sha256(children.hex().encode()).digest()


def build(leaves: bytes, climb: int) -> np.ndarray:
    """The block over these digests: its node digests by address, as rows of bytes; ``climb`` levels of runs."""
    out = np.zeros((nodes(climb + 1), WIDTH), np.uint8)
    level = leaves
    for depth in range(climb, -1, -1):
        n = len(level) // WIDTH
        out[address(depth, np.arange(n), climb + 1)] = np.frombuffer(level, np.uint8).reshape(n, WIDTH)
        if depth:
            run = FANOUT * WIDTH
            level = b"".join(parent_of(level[i : i + run]) for i in range(0, len(level), run))
    return out


def siblings(tree: np.ndarray, n: int, climb: int) -> tuple[list[list[str]], list[list[str]]]:
    """For each of the ``n`` leaves the digests left and right of its path, one text for each level of runs."""
    left, right = [[] for _ in range(n)], [[] for _ in range(n)]
    width = n
    for up in range(climb):
        depth, size = climb - up, 2 * WIDTH
        level = tree[address(depth, np.arange(width), climb + 1)].tobytes().hex()
        span = FANOUT**up
        for node in range(width):
            start = node // FANOUT * FANOUT
            before, after = level[start * size : node * size], level[(node + 1) * size : (start + FANOUT) * size]
            for leaf in range(node * span, min((node + 1) * span, n)):
                left[leaf].append(before)
                right[leaf].append(after)
        width = -(-width // FANOUT)
    return left, right


def climbs(n: int, tier: int, levels: int) -> int:
    """Levels of runs that a block of this tier has in a tree of ``n`` leaves."""
    height = 0
    while n > 1:
        n, height = -(-n // FANOUT), height + 1
    return max(0, min(levels, height - levels * tier))


@dataclass
class Forest:
    """Blocks by tier (tree, block, n, alone, digests, cells, carried columns) and the trees' roots (tree, root)."""

    tiers: list[DataFrame]
    roots: DataFrame
    levels: int


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in each ``tree``, and ``n``, the rows of the tree.

    Rows are sorted by range over all trees, so that a large tree is the work of many tasks; each partition counts its
    rows of a tree, and the counts alone are summed up.
    """
    tied = cut_lineage(rows).withColumn("tie", F.monotonically_increasing_id())
    ranged = cut_lineage(tied.repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie"))
    tagged = ranged.drop("tie").withColumn("at", F.monotonically_increasing_id())
    tagged = tagged.withColumn("part", F.shiftrightunsigned("at", _INDEX_BITS))
    counts = tagged.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("n")
    )
    placed = tagged.join(counts, ["tree", "part"])
    return placed.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def grow(leaves: DataFrame, carried: Sequence[str] = (), levels: int = LEVELS) -> Forest:
    """All blocks over ``leaves``: tree, place, n, digest (binary) and the columns that the lowest blocks carry."""
    tiers, roots, tier, block = [], [], 0, FANOUT**levels
    rows = leaves
    while True:
        cells = F.array_sort(F.collect_list(F.struct("place", "digest", *(carried if tier == 0 else ()))))
        blocks = rows.groupBy("tree", "n", F.floor(F.col("place") / block).cast("long").alias("block")).agg(cells.alias("cells"))

        def make(tier=tier):
            def work(cells, counts):
                trees = [build(b"".join(row), climbs(n, tier, levels)) for row, n in zip(cells, counts, strict=True)]
                return [[t.tobytes() for t in trees], [t[0].tobytes() for t in trees]]

            return work

        listed = blocks.withColumn("leaves", F.transform("cells", lambda c: c["digest"]))
        made = add_columns(listed, ["leaves", "n"], [("digests", pa.binary()), ("top", pa.binary())], make).drop("leaves")
        many = F.col("n") > block ** (tier + 1)
        made = cut_lineage(made.withColumn("alone", ~many))
        tiers.append(made)
        roots.append(made.where("alone").select("tree", F.col("top").alias("root"), "n"))
        # one row: whether any tree has further blocks
        if not made.agg(F.max(~F.col("alone"))).first()[0]:
            break
        rows = made.where("not alone").select("tree", "n", F.col("block").alias("place"), F.col("top").alias("digest"))
        tier += 1
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Forest(tiers, found, levels)


_PATH = [("lefts", T.ArrayType(T.StringType())), ("rights", T.ArrayType(T.StringType()))]


def _opened(blocks: DataFrame, tier: int, levels: int, carried: Sequence[str], above: Sequence[str]) -> DataFrame:
    """The leaves of blocks: tree, place, carried, lefts and rights up to the root, and the ``above`` columns of the block."""
    kinds = {f.name: f.dataType for f in blocks.schema}
    cell = {f.name: f.dataType for f in kinds["cells"].elementType}
    fields = [T.StructField("tree", kinds["tree"]), *(T.StructField(c, cell[c]) for c in ("place", *carried))]
    schema = T.StructType([*fields, *(T.StructField(a, kinds[a]) for a in above), *(T.StructField(n, k) for n, k in _PATH)])
    rows = blocks.select("tree", "n", "digests", "lefts", "rights", *above, "cells")
    at = len(rows.columns) - 1

    def run(batches):
        for batch in batches:
            trees, counts, digests, lefts, rights = (batch.column(i).to_pylist() for i in range(5))
            for i in range(batch.num_rows):
                cells = batch.column(at)[i].values
                m, climb = len(cells), climbs(counts[i], tier, levels)
                tree = np.frombuffer(digests[i], np.uint8).reshape(-1, WIDTH)
                left, right = siblings(tree, m, climb)
                names = [cells.type.field(k).name for k in range(cells.type.num_fields)]
                own = [cells.field(names.index(c)) for c in ("place", *carried)]
                same = [pa.array([batch.column(5 + k)[i].as_py()] * m, batch.column(5 + k).type) for k in range(len(above))]
                paths = [pa.array([x + up for x in side], pa.list_(pa.string())) for side, up in ((left, lefts[i]), (right, rights[i]))]
                yield pa.RecordBatch.from_arrays([pa.array([trees[i]] * m, batch.column(0).type), *own, *same, *paths], names=schema.names)

    return rows.mapInArrow(run, schema)


def descend(forest: Forest, heads: DataFrame, carried: Sequence[str], above: Sequence[str]) -> DataFrame:
    """Each leaf's carried columns with its siblings up to the end of the paths in ``heads`` (tree, lefts, rights, above).

    Paths go down tier by tier, each block's once; a leaf's whole path exists only in the task that opens its block.
    """
    paths = None
    for tier in range(len(forest.tiers) - 1, -1, -1):
        blocks = forest.tiers[tier]
        given = blocks.where("alone").join(heads, "tree")
        if paths is not None:
            lower = blocks.where("not alone").join(paths.withColumnRenamed("place", "block"), ["tree", "block"])
            given = given.unionByName(lower.select(*given.columns))
        paths = _opened(given, tier, forest.levels, carried if tier == 0 else (), above)
    return paths


def tree_name(source: Column) -> Column:
    """A name for a source that sorts as the sources do, null first, by bytes."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def manifest(
    docs: DataFrame, by: str, key: str, fields: Sequence[str], more: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row: ``key``, leaf, subroot, root (hex), lefts and rights (hex digests beside its path, level by level), ``more``.

    A leaf hashes ``fields``; leaves of one ``by`` value ascend by ``key``, null first, and equal keys by leaf, so repeated
    rows are leaves of their own beside each other. A null ``by`` is a source like any other, an empty table has no rows,
    and other columns are not looked at. ``more`` are columns worked out from ``docs`` that the leaves carry along.
    """
    named = {"tree": tree_name(col(by)), key: col(key), "leaf": F.unhex(leaf_digest(*(col(f) for f in fields)))}
    carried = [key, "digest", *(more or {})]
    rows = docs.select(*(c.alias(n) for n, c in (named | (more or {})).items()))
    order = F.struct(F.col(key), F.col("leaf"))
    leaves = positions(rows.withColumn("order", order), ["order"]).drop("order").withColumnRenamed("leaf", "digest")
    sources = grow(leaves, [key, *(more or {})], levels)
    subroots = sources.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    tops = grow(positions(subroots, ["name"]), ["name"], levels)
    empty = F.array().cast("array<string>")
    heads = tops.roots.select("tree", "root", empty.alias("lefts"), empty.alias("rights"))
    opened = descend(tops, heads, ["name", "digest"], ["root"])
    heads = opened.select(F.col("name").alias("tree"), "lefts", "rights", F.col("digest").alias("subroot"), "root")
    found = descend(sources, cut_lineage(heads), carried, ["subroot", "root"])
    text = lambda c: F.lower(F.hex(c))
    digests = [text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root")]
    return found.select(key, *digests, "lefts", "rights", *(more or {}))


def proof_digest(lefts: Column, rights: Column) -> Column:
    return F.sha2(F.concat_ws("", F.flatten(F.zip_with(lefts, rights, lambda a, b: F.array(a, b)))).cast("binary"), 256)


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    steps = F.arrays_zip(lefts.alias("l"), rights.alias("r"))
    return F.aggregate(steps, leaf, lambda now, s: F.sha2(F.concat(s["l"], now, s["r"]).cast("binary"), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered_leaf(fields: Sequence[str] = FIELDS) -> Column:
    """The leaf with A-Z of its text lower-cased, where 5 divides the id's CRC; null elsewhere, and without an id."""
    values = [lowered(col(f).cast("string")) if f == "text" else col(f) for f in fields]
    return F.when(F.crc32(col("doc_id").cast("string").cast("binary")) % 5 == 0, F.unhex(leaf_digest(*values)))


def verify(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, with some rows tampered with."""
    rows = manifest(docs, "source", "doc_id", FIELDS, {"tampered": tampered_leaf()}, levels)
    seen = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    rows = rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256"),
        folded(seen, F.col("lefts"), F.col("rights")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
