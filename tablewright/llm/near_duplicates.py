"""Near-duplicate groups by SetSketch: register bands give candidates, likelihood thins them out, full sets decide.

A sketch has REGISTERS registers. Every shingle runs its own Poisson process, hashed from the shingle, and each event
falls on a register; a register keeps the time of its first event over all shingles, truncated to the exponent of a
power of BASE. Sketches merge by maximum, and two registers are equal about as often as the sets are similar.

Texts with equal shingle sets are one class. In each band bucket, members are compared with one hub instead of with each
other. What the hubs leave apart is then compared block by block inside tasks, but only with groups that it is not linked
with yet, so a group of copies never turns into all its pairs and no link between groups is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, chunks, col, fresh, make_rows, mixed, spark_type, word_hashes
from tablewright.session import cut_lineage

SHINGLE = 2
#: Percent of the union that linked sets share.
THRESHOLD = 80
#: At the threshold one pair in a thousand million shares no band: (1 - 0.8 ** ROWS) ** BANDS.
BANDS, ROWS = 51, 5
REGISTERS = BANDS * ROWS
BASE = 1.05
#: Exponents start at 0 for times of 20 mean lives of a single shingle.
OFFSET = math.log(20, BASE)
#: A pair is dropped before its sets are compared if similarities from the threshold on are this much less likely (log).
LOG_RATIO = 20.0
#: Bands that classes of different pools share before they are compared: at the threshold 17.6 are expected, and fewer
#: than 3 come with a chance of one in ten million.
LEAST_BANDS = 3
#: Edges that a task of the component search reads, about 5 MB.
EDGES_PER_TASK = 50_000
#: Classes in a block whose full sets are compared with another block's at once, and in one whose sketches are.
BLOCK = 256
SKETCH_BLOCK = 1024
#: Pairs of sketches that are compared at once, about 10 MB.
PAIRS = 20_000


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles, with A-Z lower-cased; one for a shorter text, none without words."""
    flat, at = word_hashes([(t or "").encode().lower().split() for t in texts])
    rolled = mixed(flat)
    for k in range(1, size):
        rolled = mixed(rolled[:-1] * np.uint64(3) + flat[k:]) if len(rolled) > 1 else rolled[:0]
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:  # the length keeps it apart from full shingles
            short = hashlib.blake2b(flat[a:b].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(short, dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of register values for each non-empty set."""
    times = np.full((len(sets), REGISTERS), np.inf)
    todo, reach = np.arange(len(sets)), math.log(REGISTERS) + 8
    while len(todo):
        # events later than the horizon are not drawn; few sets leave a register empty before it and are drawn further
        sizes = np.array([len(sets[i]) for i in todo])
        own = np.repeat(np.arange(len(todo)), sizes)
        seeds, horizon = np.concatenate([sets[i] for i in todo]), reach / sizes
        now, k = np.zeros(len(seeds)), 0
        first = np.full(len(todo) * REGISTERS, np.inf)
        while len(seeds):
            z = mixed(seeds + np.uint64((k * 0xD1342543DE82EF95) % 2**64))
            now = now - np.log(((z >> np.uint64(24)) + np.uint64(1)) * 2.0**-40) / REGISTERS
            live = now < horizon[own]
            seeds, own, now, z = seeds[live], own[live], now[live], z[live]
            register = ((z & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS)) >> np.uint64(24)
            np.minimum.at(first, own * REGISTERS + register.astype(np.int64), now)
            k += 1
        first = first.reshape(len(todo), REGISTERS)
        done = np.isfinite(first).all(axis=1)
        times[todo[done]] = first[done]
        todo, reach = todo[~done], 2 * reach
    # the low byte is enough: registers of like sets are less than 128 steps, a factor of 500, apart
    return np.clip(np.floor(1 + OFFSET - np.log(times) / math.log(BASE)), 0, 2**15 - 1).astype(np.uint16).astype(np.uint8)


def _digests(size: int):
    def make():
        seen: set[bytes] = set()

        def work(texts):
            counts, digests, found = [], [], []
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], size)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                new = {}
                for key, s in zip(keys, sets, strict=True):
                    if key and key not in seen:
                        seen.add(key)
                        new[key] = s
                rows = dict(zip(new, sketches(list(new.values())), strict=True)) if new else {}
                for key, s in zip(keys, sets, strict=True):
                    counts.append(len(s))
                    digests.append(key)
                    found.append(rows.pop(key).tobytes() if key in rows else None)
            return counts, digests, found

        return work

    return make


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def described(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n, digest (null without words), sketch (on one row of a digest in each task)."""
    rows = docs.select(col("doc_id"), col("text").cast("string").alias("text"))
    kinds = [("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())]
    return add_columns(rows.withColumn("text_key", text_key(F.col("text"))), ["text"], kinds, _digests(size)).drop("text")


def fits(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def band_keys(found: list[bytes]) -> np.ndarray:
    """A row of hashed register values, one for each band, for each sketch."""
    registers = np.frombuffer(b"".join(found), dtype=np.uint8).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), registers.shape[:2])
    for r in range(ROWS):
        key = mixed(key * np.uint64(65_537) + registers[:, :, r])
    return key.view(np.int64)


def band_rows(classes: DataFrame) -> DataFrame:
    """(bands, digest, n): each class with its bands' hashed register values."""

    def work(batches):
        for digests, counts, found in batches:
            yield [band_keys(found).tolist(), digests, counts]

    kinds = [("bands", pa.list_(pa.int64())), ("digest", pa.binary()), ("n", pa.int64())]
    return make_rows(classes.select("digest", "n", "sketch"), kinds, work)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest similarity of pairs of sketches, given the sets' sizes, and the log ratio against the threshold.

    With u, v the sizes' shares, a register of the first is larger with chance p(u - v J), smaller with p(v - u J) and
    equal otherwise, where p(x) = -log_b(1 - x (b - 1) / b).
    """
    step = (a - b).view(np.int8)
    more, less = (step > 0).sum(axis=1)[:, None], (step < 0).sum(axis=1)[:, None]
    same = REGISTERS - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 201)[None, :]
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u - v * grid), p(v - u * grid)
    fit = more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))
    fit = np.where(grid <= np.minimum(u / v, v / u) + 0.005, fit, -np.inf)
    return grid[0, fit.argmax(axis=1)], fit.max(axis=1) - fit[:, grid[0] >= THRESHOLD / 100 - 0.006].max(axis=1)


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs a, b with a likely similarity (estimate); those far below the threshold are left out."""
    side = lambda x: classes.select(F.col("digest").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def work(batches):
        for a, b, na, nb, sa, sb in batches:
            at = [np.frombuffer(b"".join(s), dtype=np.uint8).reshape(-1, REGISTERS) for s in (sa, sb)]
            best, short = similarity(*at, np.array(na, float), np.array(nb, float))
            keep = np.flatnonzero(short <= LOG_RATIO)
            yield [[a[i] for i in keep], [b[i] for i in keep], best[keep].tolist()]

    return make_rows(both, [("a", pa.binary()), ("b", pa.binary()), ("estimate", pa.float64())], work)


def class_sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """digest, shingles: the full sets of the classes, made from the text of one member each."""
    wanted = classes.select("rep", "rep_key")
    rows = docs.select(col("doc_id"), col("text").cast("string").alias("text")).withColumn("text_key", text_key(F.col("text")))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key")), "left_semi")

    def work(batches):
        for (texts,) in batches:
            for a, b in chunks(texts):
                sets = [s for s in shingle_sets(texts[a:b], size) if len(s)]
                yield [[hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], [s.tobytes() for s in sets]]

    return make_rows(rows.select("text"), [("digest", pa.binary()), ("shingles", pa.binary())], work)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose full sets share at least THRESHOLD percent of their union."""
    side = lambda x: sets.select(F.col("digest").alias(x), F.col("shingles").alias(f"s_{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")

    def linked(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        total = np.concatenate([x, y])
        total.sort(kind="stable")
        shared = int((total[1:] == total[:-1]).sum())
        return 100 * shared >= THRESHOLD * (len(x) + len(y) - shared)

    def work(batches):
        for a, b, sa, sb in batches:
            keep = [i for i in range(len(a)) if linked(sa[i], sb[i])]
            yield [[a[i] for i in keep], [b[i] for i in keep]]

    return make_rows(both, [("a", pa.binary()), ("b", pa.binary())], work)


def forests(edges: DataFrame) -> DataFrame:
    """Edges a, b with the same components: of EDGES_PER_TASK edges at a time, each node with the least that it reaches by them."""
    kind = next(k for k in (pa.binary(), pa.int64(), pa.string()) if spark_type(k) == edges.schema["a"].dataType)

    def stars(pairs):
        parent: dict = {}

        def top(node):
            while (up := parent.setdefault(node, node)) != node:
                parent[node] = node = parent[up]
            return node

        for a, b in pairs:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
        found = [(node, root) for node in list(parent) if (root := top(node)) != node]
        return [[node for node, _ in found], [root for _, root in found]]

    def work(batches):
        held = []
        for a, b in batches:
            held += zip(a, b, strict=True)
            if len(held) >= EDGES_PER_TASK:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    return make_rows(edges.select("a", "b"), [("a", kind), ("b", kind)], work)


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges a, b: root is the least node that can be reached.

    Stars of some edges at a time within tasks, then large and small stars over all edges in turn, until nothing changes.
    Each of these steps lowers the edges' ends or leaves all as they are. Every round is written out; only its count and a
    checksum come to the driver.
    """

    def mark(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    def gathered(df, rows):  # no more partitions than the rows are worth
        return df.coalesce(max(1, min(df.rdd.getNumPartitions(), rows // EDGES_PER_TASK + 1)))

    now = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(now)
    while before[0]:
        now = cut_lineage(forests(gathered(now, before[0])))
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _rooted(df: DataFrame, name: str, roots: DataFrame) -> DataFrame:
    """``df`` with the root of the class in column ``name``, itself where it has no link, as ``root_<name>``."""
    side = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(side, F.col(name) == F.col("_node"), "left").withColumn(f"root_{name}", F.coalesce("_root", name)).drop("_node", "_root")


def class_roots(docs: DataFrame, classes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """node, root for the classes (digest, n, sketch, rep, rep_key) that are linked with another."""
    banded = band_rows(classes)
    rows = banded.select(F.explode("bands").alias("band"), "digest", "n")
    # the hub of a bucket is the class whose hash with the band comes first; counts and hashes alone are grouped
    order = F.xxhash64("digest", "band")
    met = rows.groupBy("band").agg(F.count("*").alias("size"), F.min(order).alias("first")).where("size > 1")
    members = cut_lineage(rows.join(met.drop("size"), "band"))
    hubs = members.where(order == F.col("first")).select("band", F.struct("digest", "n").alias("hub"))
    members = members.select("band", "digest", "n")
    met_hub = members.join(hubs, "band")
    star = (
        met_hub.where((F.col("digest") != F.col("hub.digest")) & fits(F.col("n"), F.col("hub.n")))
        .select(F.col("digest").alias("a"), F.col("hub.digest").alias("b")).distinct()
    )
    star = cut_lineage(plausible(star, classes))
    # each class is first compared with the two hubs that are likest; a class has at most one hub a band
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("estimate"), "b"))
    first = star.withColumn("place", place).where("place <= 2")
    needed = members.select("digest").distinct().join(classes, "digest")
    sets = cut_lineage(class_sets(docs, needed, size))
    links = cut_lineage(confirmed(first, sets))
    pools = cut_lineage(components(star))
    within = pool_links(pools, links, sets)
    return components(links.unionByName(within).unionByName(between_pools(members, pools, classes, sets)))


def pool_links(pools: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b that join the members of each pool (node, root) of likely similar classes as far as they are linked.

    The core of a pool is the hub with the most links (member a, hub b) and the classes that are linked with it. Core and
    other members are cut into blocks of BLOCK classes, and each block of others meets each block of the core and of the
    others in a task that compares their full sets. Pairs within the core are never made, and of each meeting's links
    only a forest leaves the task, so rows grow with the members and not with their pairs.
    """
    rows = pools.select(F.col("root").alias("pool"), F.col("node").alias("digest"))
    degree = links.groupBy(F.col("b").alias("digest")).agg(F.count("*").alias("degree"))
    # a pool without links is all others: its core is its least member alone
    hubs = rows.join(degree, "digest", "left").groupBy("pool").agg(
        F.max_by("digest", F.struct(F.coalesce("degree", F.lit(0)), "digest")).alias("hub"), F.count("*").alias("n")
    ).where("n > 1")
    near = links.select(F.col("a").alias("digest"), F.col("b").alias("hub")).distinct().withColumn("near", F.lit(True))
    rows = rows.join(hubs, "pool").join(near, ["digest", "hub"], "left")
    rows = cut_lineage(rows.withColumn("own", F.coalesce("near", F.lit(False)) | (F.col("digest") == F.col("hub"))).drop("near"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = rows.groupBy("pool").agg(
        blocks(F.count_if("own")).alias("core_blocks"), blocks(F.count_if(~F.col("own"))).alias("blocks")
    ).where("blocks > 0")
    own = F.pmod(F.xxhash64("digest"), F.when(F.col("own"), F.col("core_blocks")).otherwise(F.col("blocks"))).cast("int")
    span = lambda n: F.sequence(F.lit(0), n - 1)
    meet = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    mine = F.col("block")
    with_core = F.transform(span(F.col("core_blocks")), lambda i: meet("core", i, mine))
    with_others = F.transform(span(F.col("blocks")), lambda j: meet("rest", F.least(mine, j), F.greatest(mine, j)))
    to = F.when(F.col("own"), F.transform(span(F.col("blocks")), lambda j: meet("core", mine, j))).otherwise(F.concat(with_core, with_others))
    dealt = rows.join(sizes, "pool").withColumn("block", own).select("pool", "digest", "block", "own", F.explode(to).alias("at"))
    dealt = dealt.join(sets, "digest").select("pool", "at", "own", "block", "digest", "shingles")
    dealt = dealt.repartition("pool", "at").sortWithinPartitions("pool", "at")

    def work(batches):
        key, held = None, []
        for columns in batches:
            for pool, at, *row in zip(*columns, strict=True):
                if (now := (pool, *at.values())) != key:
                    if held:
                        yield _block_links(held, key)
                    key, held = now, []
                held.append(row)
        if held:
            yield _block_links(held, key)

    return make_rows(dealt, [("a", pa.binary()), ("b", pa.binary())], work)


def _block_links(rows: list[list], key: tuple) -> list[list[bytes]]:
    """A forest of the links between the two blocks of one meeting, from rows (own, block, digest, shingles).

    The members of a core are linked with each other already, so one link with it is enough for each of the others.
    """
    _, kind, i, _ = key
    left = [r for r in rows if (r[0] if kind == "core" else r[1] == i)]
    right = [r for r in rows if not (r[0] if kind == "core" else r[1] == i)] or (left if kind == "rest" else [])
    if not left or not right:
        return [[], []]
    x, y = ([np.frombuffer(r[3], np.uint64) for r in side] for side in (left, right))
    shared = shared_counts(x, y)
    nx, ny = (np.array([len(s) for s in side])[:, None] for side in (x, y))
    hit = 100 * shared >= THRESHOLD * (nx + ny.T - shared)
    if kind == "core":
        at = np.flatnonzero(hit.any(axis=0))
        return [[left[p][2] for p in hit.argmax(axis=0)[at]], [right[q][2] for q in at]]
    parent: dict[bytes, bytes] = {}

    def top(node: bytes) -> bytes:
        while (up := parent.get(node, node)) != node:
            parent[node] = node = parent.get(up, up)
        return node

    forest = []
    for p, q in np.argwhere(hit):
        a, b = left[p][2], right[q][2]
        if (ra := top(a)) != (rb := top(b)):
            parent[ra] = rb
            forest.append((a, b))
    return [[a for a, _ in forest], [b for _, b in forest]]


def shared_counts(x: list[np.ndarray], y: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``, ``width`` shared elements at a time."""
    common = np.intersect1d(np.concatenate(x), np.concatenate(y))
    counts = np.zeros((len(x), len(y)), dtype=np.int64)
    for start in range(0, len(common), width):
        part = common[start : start + width]
        marks = []
        for side in (x, y):
            mark = np.zeros((len(side), len(part)), dtype=np.float32)
            for row, s in zip(mark, side, strict=True):
                inside = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, inside)
                row[at[part[at] == inside]] = 1
            marks.append(mark)
        counts += (marks[0] @ marks[1].T).astype(np.int64)  # whole numbers up to width are exact in float32
    return counts


def between_pools(members: DataFrame, pools: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b of classes in one band bucket whose likeness to the bucket's hub did not bring them into one pool.

    Texts that share a passage but little else meet here in great numbers. A bucket is cut into blocks of SKETCH_BLOCK
    classes, and a task compares the sketches of two blocks; only pairs that are likely similar leave it, each from the
    first band that it shares, so rows grow with the members and not with their pairs.
    """
    rest = _rooted(members, "digest", pools).withColumnRenamed("root_digest", "root")
    split = rest.groupBy("band").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.ceil(F.count("*") / SKETCH_BLOCK).cast("int").alias("blocks")
    ).where("x != y").select("band", "blocks")
    rest = rest.join(split, "band").join(classes.select("digest", "sketch"), "digest")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    meet = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")),
    )
    dealt = rest.select("band", F.explode(meet).alias("at"), "block", "digest", "root", "n", "sketch")
    dealt = dealt.repartition("band", "at").sortWithinPartitions("band", "at")

    def work(batches):
        key, held = None, []
        for columns in batches:
            for band, at, *row in zip(*columns, strict=True):
                if (now := (band, at["i"], at["j"])) != key:
                    if held:
                        yield from _likely_pairs(held, *key)
                    key, held = now, []
                held.append(row)
        if held:
            yield from _likely_pairs(held, *key)

    pairs = make_rows(dealt, [("a", pa.binary()), ("b", pa.binary())], work)
    return confirmed(cut_lineage(pairs), sets)


def _likely_pairs(rows: list[list], band: int, i: int, j: int):
    """Pairs of different pools between blocks i and j of a bucket, from rows (block, digest, root, n, sketch).

    Pairs that share fewer than LEAST_BANDS bands, or an earlier band than this one, are left out before the likelihood.
    """
    left, right = ([r for r in rows if r[0] == side] for side in (i, j))
    if not left or not right:
        return
    place = int(np.flatnonzero(band_keys([left[0][4]])[0] == band)[0])
    code = {root: k for k, root in enumerate({r[2] for r in rows})}
    (ra, na, a), (rb, nb, b) = (
        (np.array([code[r[2]] for r in side]), np.array([r[3] for r in side], float),
         np.frombuffer(b"".join(r[4] for r in side), np.uint8).reshape(-1, REGISTERS))
        for side in (left, right)
    )
    met = (ra[:, None] != rb) & (100 * np.minimum(na[:, None], nb) >= THRESHOLD * np.maximum(na[:, None], nb))
    p, q = np.nonzero(np.triu(met, 1) if i == j else met)
    for start in range(0, len(p), PAIRS):
        x, y = p[start : start + PAIRS], q[start : start + PAIRS]
        shared = (a[x] == b[y]).reshape(-1, BANDS, ROWS).all(axis=2)
        own = np.flatnonzero((shared.sum(axis=1) >= LEAST_BANDS) & (shared.argmax(axis=1) == place))
        if len(own):
            x, y = x[own], y[own]
            _, short = similarity(a[x], b[y], na[x], nb[y])
            likely = np.flatnonzero(short <= LOG_RATIO)
            yield [[left[k][1] for k in x[likely]], [right[k][1] for k in y[likely]]]


def groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, root (the component itself, null without words).

    Null and empty texts have no shingles and are linked with nothing. Rows without an id take part, but a component is
    called by its smallest id, null if none of its rows has one. Every row stays, repeated ones too.
    """
    rows = cut_lineage(described(docs, size))
    rep = F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = cut_lineage(
        rows.where(F.col("digest").isNotNull()).groupBy("digest")
        .agg(F.max("n").alias("n"), F.first("sketch", ignorenulls=True).alias("sketch"), rep.alias("r"))
        .select("digest", "n", "sketch", F.col("r.doc_id").alias("rep"), F.col("r.text_key").alias("rep_key"))
    )
    roots = cut_lineage(class_roots(docs, classes, size))
    named = roots.join(classes.select(F.col("digest").alias("node"), "rep"), "node")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    labels = roots.join(least, "root").select(F.col("node").alias("digest"), "least", "root")
    labelled = classes.select("digest", "rep").join(labels, "digest", "left").select(
        "digest", F.when(F.col("root").isNotNull(), F.col("least")).otherwise(F.col("rep")).alias("label"),
        F.coalesce("root", "digest").alias("root"),
    )
    label = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("label"))
    return rows.drop("sketch").join(labelled, "digest", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), label.alias("component_id"), "root"
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (whether its id names the component)."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return groups(docs, size).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def deduplicate(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of each group, with its own columns only: that with the least doc_id, ids before nulls, then by text hash.

    Of repeated rows with the same id and text one stays. Texts without words are in no group, so each of them stays but
    for such repetitions.
    """
    at, key, n = fresh(docs, "kept_id", "kept_key", "kept_rows")
    texts = cut_lineage(groups(docs, size).groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.first("root").alias("root")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n")).alias("first")
    chosen = texts.where(F.col("root").isNotNull()).groupBy("root").agg(first).select("first.doc_id", "first.text_key", "first.n")
    chosen = chosen.unionByName(texts.where(F.col("root").isNull()).drop("root"))
    wanted = cut_lineage(chosen.select(F.col("doc_id").alias(at), F.col("text_key").alias(key), F.col("n").alias(n)))
    same = col("doc_id").eqNullSafe(col(at)) & (text_key(col("text").cast("string")) == col(key))
    keyed = docs.join(wanted, same)
    repeated = keyed.where(col(n) > 1).dropDuplicates([at, key])
    return keyed.where(col(n) == 1).unionByName(repeated).select(*(col(c) for c in docs.columns))
