"""Groups of like SimHash fingerprints, found through pivot distance tables.

Fingerprints of 64 bits lie in a metric space: two of them are at least as far apart as their distances to any reference
fingerprint (a pivot) differ. For each of six blocks of bits a table holds the distances of all block values to PIVOTS
reference fingerprints. Fingerprints within RADIUS bits agree on at least three blocks, so they have equal rows of
these three tables, and a hash of the three rows is the key under which they meet. Of those that meet, pairs whose
distances to any pivot differ by more than RADIUS are discarded, and the rest are verified bit by bit.

A key that more than CROWD fingerprints share is cut again in the same way, over the bits that it leaves free. At most
18 bits are free then, so that no meeting has more than 262,144 different fingerprints, however many copies there are.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, col, make_rows, mixed
from tablewright.llm.near_duplicates import components
from tablewright.session import cut_lineage

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCKS = 2 * RADIUS
PIVOTS = 32
CROWD = 2048
#: Pairs that a task compares at once.
AT_ONCE = 1 << 21
#: A fingerprint of more than one row in HOT has its label broadcast; there are fewer than HOT of them.
HOT = 1000

#: For each byte value a number whose byte k is bit k of the value.
_LANES = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).view(np.uint64)[:, 0]


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of the text's shingles, repeats included: one for a text of fewer words, none without words."""
    words = (text or "").encode().lower().split()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed number; zero for none."""
    counts = np.zeros(64, np.int64)
    values = hashes.view(np.uint8).reshape(-1, 8)
    for start in range(0, len(values), 255):  # a lane holds counts up to 255
        lanes = _LANES[values[start : start + 255]].sum(axis=0, dtype=np.uint64)
        counts += lanes.view(np.uint8)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (long) of each row's whole text."""

    def make():
        return lambda texts: [[fingerprint(shingle_hashes(t, size)) for t in texts]]

    rows = docs.select(col("doc_id"), col("text").cast("string").alias("text"))
    return add_columns(rows, ["text"], [("fingerprint", pa.int64())], make).drop("text")


class PivotTables:
    """Distances of block values to the pivots, for blocks that tile ``bits``; ``TABLES`` choose half of the blocks."""

    TABLES = list(combinations(range(BLOCKS), BLOCKS - RADIUS))

    def __init__(self, bits: list[int]):
        self.blocks = [list(b) for b in np.array_split(np.array(bits), BLOCKS)]
        self.pivots = mixed(np.arange(1, PIVOTS + 1, dtype=np.uint64))
        self.distances, self.names = [], []
        for block in self.blocks:
            values = np.arange(1 << len(block), dtype=np.uint64)
            table = np.bitwise_count(values[:, None] ^ self.values(self.pivots, block)[None, :])
            name = np.full(len(values), len(self.names), dtype=np.uint64)
            for column in table.T:
                name = mixed(name * np.uint64(65_537) + column)
            self.distances.append(table.astype(np.uint8))
            self.names.append(name)

    @staticmethod
    def values(prints: np.ndarray, block: list[int]) -> np.ndarray:
        """The block's bits of each fingerprint, as small numbers."""
        out = np.zeros(len(prints), np.uint64)
        for k, bit in enumerate(block):
            out |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
        return out

    def keys(self, prints: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """A row of keys for each fingerprint: hashes of the table rows of each choice of blocks."""
        rows = [name[self.values(prints, block)] for name, block in zip(self.names, self.blocks, strict=True)]
        out = np.empty((len(prints), len(self.TABLES)), np.uint64)
        for t, chosen in enumerate(self.TABLES):
            key = np.full(len(prints), t, np.uint64) + np.asarray(salt, np.uint64)
            for b in chosen:
                key = mixed(key * np.uint64(65_537) + rows[b])
            out[:, t] = key
        return out

    def coordinates(self, prints: np.ndarray) -> np.ndarray:
        """Distances of whole fingerprints to all pivots."""
        out = np.zeros((len(prints), PIVOTS), np.uint8)
        for table, block in zip(self.distances, self.blocks, strict=True):
            out += table[self.values(prints, block)]
        return out

    def free_bits(self, table: int) -> list[int]:
        return [bit for b, block in enumerate(self.blocks) if b not in self.TABLES[table] for bit in block]


def whole_tables() -> PivotTables:
    return PivotTables(list(range(64)))


def _dealt(prints: DataFrame) -> DataFrame:
    """key, part (the choice of blocks), fingerprint: each fingerprint under the keys of all choices."""

    def work(batches):
        tables = whole_tables()
        count = len(tables.TABLES)
        for (found,) in batches:
            x = np.array(found, np.int64)
            keys = tables.keys(x.view(np.uint64)).view(np.int64).ravel()
            yield [pa.array(keys), pa.array(np.tile(np.arange(count, dtype=np.int32), len(x))), pa.array(np.repeat(x, count))]

    kinds = [("key", pa.int64()), ("part", pa.int32()), ("fingerprint", pa.int64())]
    return make_rows(prints.select("fingerprint"), kinds, work)


def _dealt_again(rows: DataFrame) -> DataFrame:
    """key, fingerprint: the rows of crowded keys under keys that also cover half of the bits left free."""

    def work(batches):
        whole = whole_tables()
        parts = [PivotTables(whole.free_bits(t)) for t in range(len(whole.TABLES))]
        for keys, at, found in batches:
            k, at, x = np.array(keys, np.int64).view(np.uint64), np.array(at), np.array(found, np.int64)
            out, own = [], []
            for t in np.unique(at):
                mine = at == t
                new = parts[t].keys(x[mine].view(np.uint64), k[mine])
                out.append(new.view(np.int64).ravel())
                own.append(np.repeat(x[mine], new.shape[1]))
            yield [pa.array(np.concatenate(out)), pa.array(np.concatenate(own))] if out else [[], []]

    return make_rows(rows.select("key", "part", "fingerprint"), [("key", pa.int64()), ("fingerprint", pa.int64())], work)


def near_pairs(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """Which pairs x[i], y[i] are within RADIUS: first by their distances to the pivots, then bit by bit."""
    far = np.abs(cx.astype(np.int8) - cy.astype(np.int8)).max(axis=-1) > RADIUS
    found = ~far
    found[found] = np.bitwise_count(x[found] ^ y[found]) <= RADIUS
    return found


def group_links(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within one meeting, as positions: rows grow with the members, not with their pairs."""
    label = np.arange(len(x))
    a, b = [], []
    strip = max(1, AT_ONCE // (len(x) * PIVOTS))
    for start in range(0, len(x) - 1, strip):
        rows = np.arange(start, min(start + strip, len(x) - 1))
        i, j = np.repeat(rows, len(x) - start), np.tile(np.arange(start, len(x)), len(rows))
        i, j = i[i < j], j[i < j]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        hit = near_pairs(x[i], x[j], c[i], c[j])
        for p, q in zip(i[hit].tolist(), j[hit].tolist()):
            if label[p] != label[q]:
                a.append(p)
                b.append(q)
                label[label == max(label[p], label[q])] = min(label[p], label[q])
    return np.array(a, np.int64), np.array(b, np.int64)


def _links(rows: DataFrame) -> DataFrame:
    """Links a, b of the fingerprints that meet, from rows (key, fingerprint) that lie together by key."""

    def found(keys: np.ndarray, prints: np.ndarray, tables: PivotTables) -> list:
        cut = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1, append=keys[-1:] + 1))
        sizes = np.diff(cut)
        a, b = [], []
        at = cut[:-1][sizes == 2]
        for start in range(0, len(at), AT_ONCE // PIVOTS):
            part = at[start : start + AT_ONCE // PIVOTS]
            x, y = prints[part], prints[part + 1]
            hit = near_pairs(x, y, tables.coordinates(x), tables.coordinates(y))
            a.append(x[hit])
            b.append(y[hit])
        for i in np.flatnonzero(sizes > 2):
            x = np.unique(prints[cut[i] : cut[i + 1]])
            p, q = group_links(x, tables.coordinates(x))
            a.append(x[p])
            b.append(x[q])
        return [pa.array(np.concatenate(s).view(np.int64)) for s in (a, b)] if a else [[], []]

    def work(batches):
        tables = whole_tables()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for keys, prints in batches:
            k, x = np.array(keys, np.int64), np.array(prints, np.int64).view(np.uint64)
            last = np.searchsorted(k, k[-1]) if len(k) else 0
            if last or (len(k) and held and held[-1][0][-1] != k[0]):
                held.append((k[:last], x[:last]))
                yield found(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), tables)
                held = []
            if len(k):
                held.append((k[last:], x[last:]))
        if held:
            yield found(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), tables)

    return make_rows(rows.select("key", "fingerprint"), [("a", pa.int64()), ("b", pa.int64())], work)


def links(prints: DataFrame) -> DataFrame:
    """Links a, b between different fingerprints within RADIUS bits, enough of them to join all that are linked."""
    rows = _dealt(prints)
    crowded = rows.groupBy("key").agg(F.count("*").alias("met")).where(F.col("met") > 1)
    rows = rows.join(crowded, "key")
    again = _dealt_again(rows.where(F.col("met") > CROWD))
    together = rows.where(F.col("met") <= CROWD).select("key", "fingerprint").unionByName(again)
    return _links(together.repartition("key").sortWithinPartitions("key"))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def simhash_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    A component is called by its smallest id, null if none of its rows has one. Texts that are null, empty or without
    words have fingerprint zero and are linked like any other. Repeated rows stay. Other columns are not looked at.
    """
    rows = cut_lineage(fingerprints(docs, size))
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(links(prints))
    joined = prints.join(roots, prints.fingerprint == roots.node, "left").withColumn("root", F.coalesce("root", "fingerprint"))
    joined = cut_lineage(joined.select("fingerprint", "least", "n", "root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut_lineage(joined.join(named, "root").select(F.col("fingerprint").alias("own"), "n", "component_id"))
    # each of the hot fingerprints has more than a thousandth of all rows, so there are fewer than HOT of them
    total = labels.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(labels.where(F.col("n") * HOT > total).select("own", "component_id", F.lit(True).alias("hot")))
    placed = rows.join(hot, F.col("fingerprint") == F.col("own"), "left").drop("own")
    rest = placed.where(F.col("hot").isNull()).drop("hot", "component_id").join(
        labels.where(F.col("n") * HOT <= total), F.col("fingerprint") == F.col("own")
    )
    out = ["doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"]
    return placed.where("hot").select(*out).unionByName(rest.select(*out))
