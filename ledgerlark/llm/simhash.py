"""SimHash near-dedup: BK-trees over fingerprints, sharded by shared bits.

Fingerprints within `radius` bits of each other agree in one of radius + 1 groups of bits at least,
so each shard holds the fingerprints with one value of one group; more, larger combinations of
groups are used as the number of fingerprints grows, which keeps shards small. In a shard the
fingerprints form a BK-tree: a child hangs on its parent's edge with their Hamming distance, and a
search follows only the edges within the radius. Trees are built where their shard is, since all of
them together grow with the corpus and could not be broadcast. A shard gives a spanning forest of
its links; a distributed star contraction joins the shards' forests.

The pipeline keeps one document of each group whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more. No number of SimHash bits bounds that, so that stage's trees hold odd
sketches, the parities of a set's shingles in some cells: two sketches never differ in more bits
than their sets in shingles, so the radius |A ^ B| <= (|A| + |B|) / 9 misses no pair. Shards come
from a prefix filter, which misses none either: sets that similar share one of their first
size // 5 + 1 shingles in any common order. What the trees find counts after its exact similarity.
Groups of near copies around 0.8 have very many such pairs, so pairs stay in the task that finds
them: it gives its rows' clusters, a row each, which finer sketches divide and whole sets decide.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import flat, release, shared_checkpoint, word_bounds

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Words of a shingle in the pipeline's stage; its similarity is 4 / 5, in whole numbers where it is used.
WORDS = 5
#: Shingles that come last in the order of prefixes: those in COMMON sampled texts or more, the MOST_COMMON first.
COMMON, MOST_COMMON = 4, 1 << 17
#: Bytes of the trees' odd sketches: a quarter of the fine ones' (2 to 4 bits a shingle), within these. With
#: half a bit a shingle and more, sets that share little differ in more bits than similar ones can.
LEAST_COARSE, MOST_COARSE = 128, 512
#: Rows of one shingle's run or one shard that a task holds; longer runs are split in cells and their cells compared in turn.
RUN = 200_000
#: Rows of a small side that are broadcast, after they are counted; more are shuffled. Also edges that one task joins.
SMALL = 1 << 19
#: Small rows of a checkpoint's file.
FILE = 1 << 18
#: Fingerprints that a shard should have, about.
SHARD = 64
#: Parts in which a component's prints meet its least id.
PARTS = 16
CHUNK = 1 << 21
PAIRS = 1 << 20
#: Shingles of a cluster that a task holds as sets; a larger one is cut, and its cuts meet in pairs. Pairs that are merged at once.
CUT, HELD = 1 << 21, 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: A byte's bits, each in its own byte of a 64-bit number, the lowest first.
_SPREAD = np.array([sum(((i >> b) & 1) << (8 * b) for b in range(8)) for i in range(256)], np.uint64)


def shingle_hashes(column, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' shingles, one row after the other, and each row's number of them. A text of fewer words is one shingle."""
    buf, at = flat(column)
    buf = _LOWER[buf]
    starts, ends, first = word_bounds(buf, at)
    size = ends - starts
    place = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.full(int(place[-1]), 32, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    index = np.repeat(np.arange(len(size)), size)
    text[place[index] + inside] = buf[starts[index] + inside]
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    row = np.repeat(np.arange(len(count)), count)
    begin = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    stop = np.minimum(begin + shingle, first[1:][row])
    data, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(place[begin].tolist(), (place[stop] - 1).tolist(), strict=True)), np.uint64, len(begin))
    return hashes, count


def fingerprints(column, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each row: bit b is 1 if it is in over half of the shingles' hashes; 0 for a row without words."""
    hashes, count = shingle_hashes(column, shingle)
    out = np.zeros(len(count), np.uint64)
    if not len(hashes):
        return out
    # counts of each bit: sums of spread bytes over runs of at most 255 hashes of one row
    run = np.zeros(len(hashes), bool)
    offset = np.arange(len(hashes)) - np.repeat(np.cumsum(count) - count, count)
    run[offset % 255 == 0] = True
    runs = np.flatnonzero(run)
    have = count > 0
    row_runs = np.flatnonzero(offset[runs] == 0)
    for k in range(8):
        part = np.add.reduceat(_SPREAD[((hashes >> np.uint64(8 * k)) & np.uint64(255)).astype(np.int64)], runs)
        ones = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), row_runs)
        bits = (2 * ones > count[have][:, None]).astype(np.uint64)
        out[have] |= (bits << (np.arange(8, dtype=np.uint64) + np.uint64(8 * k))).sum(axis=1, dtype=np.uint64)
    return out


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of CHUNK bytes of text, about."""
    size = np.cumsum(np.diff(flat(batch["text"])[1]))
    at = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), batch.num_rows]
    for a, b in zip(at, at[1:], strict=False):
        yield batch.slice(a, b - a)


class Forest:
    """BK-trees, one per group, over rows of 64-bit words; items of a group hang below its first item."""

    def __init__(self, values: np.ndarray, group: np.ndarray) -> None:
        n = len(values)
        self.values, self.parent, self.edge = values.reshape(n, -1), np.full(n, -1, np.int64), np.zeros(n, np.int64)
        self.edges = 64 * self.values.shape[1] + 1  # distances that an edge can have
        _, root = np.unique(group, return_index=True)
        rank = np.empty(int(group.max()) + 1, np.int64)
        rank[group[root]] = root
        self.root = rank[group]
        left = np.flatnonzero(self.root != np.arange(n))
        at = self.root[left]
        while len(left):
            d = self.distance(left, at)
            key = at * self.edges + d
            _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            child = left[first]
            self.parent[child], self.edge[child] = at[first], d[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], child[inverse][rest]
        inner = np.flatnonzero(self.parent >= 0)
        key = self.parent[inner] * self.edges + self.edge[inner]
        order = np.argsort(key)
        self.keys, self.children = key[order], inner[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.values[a] ^ self.values[b]).sum(axis=1, dtype=np.int64)

    def near(self, query: np.ndarray, radius: int | np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query item, found item) within the radius, one or one an item, found in the query's own tree."""
        radius = np.broadcast_to(np.asarray(radius, np.int64), len(self.values))
        most = PAIRS // self.values.shape[1]
        stack = [(query, self.root[query])]
        while stack:
            q, node = stack.pop()
            if len(q) > most:
                stack += [(q[a : a + most], node[a : a + most]) for a in range(0, len(q), most)]
                continue
            d = self.distance(q, node)
            hit = d <= radius[q]
            if hit.any():
                yield q[hit], node[hit]
            base = node * self.edges
            lo = np.searchsorted(self.keys, base + np.maximum(d - radius[q], 0))
            hi = np.searchsorted(self.keys, base + np.minimum(d + radius[q], self.edges - 1), "right")
            many = hi - lo
            go = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            if len(go):
                stack.append((np.repeat(q, many), self.children[go]))


def _components(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least label reachable: hook to smaller labels and jump."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
        if (label == before).all():
            return label


def _merge(pairs: Iterator[tuple[np.ndarray, np.ndarray]], item: np.ndarray, holds=None) -> np.ndarray:
    """The least item that each item reaches by the pairs of rows (a, b); `holds` is asked for those that do not reach each other yet."""
    label = np.arange(int(item.max()) + 1)

    def join(held: list, label: np.ndarray) -> np.ndarray:
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        new = label[item[a]] != label[item[b]]
        a, b = a[new], b[new]
        if holds is not None and len(a):
            ok = holds(a, b)
            a, b = a[ok], b[ok]
        return _components(item[a], item[b], label) if len(a) else label

    held, many = [], 0
    for a, b in pairs:
        new = label[item[a]] != label[item[b]]
        if new.any():
            held.append((a[new], b[new]))
            many += len(held[-1][0])
        if many >= HELD:
            label, held, many = join(held, label), [], 0
    return join(held, label) if held else label


def tables(n: int, radius: int = RADIUS) -> list[int]:
    """Masks of bits, such that numbers within the radius agree on one of them at least, and about SHARD of n share a value."""
    for extra in range(1, 5):
        groups = radius + extra
        cuts = [round(64 * i / groups) for i in range(groups + 1)]
        masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(cuts)]
        if n <= SHARD << (64 * extra // groups):
            break
    return [sum(c) for c in itertools.combinations(masks, extra)]


def in_cells(rows: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """Rows whose `cell` says where a large group is cut, in the cells in which each two of its cuts meet.

    split has the large groups (_key of the key's name) and their number of cuts, `cells`. No task gets
    more than two cuts of a group, and every two rows of a group are in one cell.
    """
    joined = rows.join(split, F.col(key) == F.col(f"_{key}"), "left")
    own = F.pmod("cell", "cells")
    other = F.explode(F.when(F.col("cells").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("cells") - 1)))
    pair = F.least(own, "_other") * F.col("cells") + F.greatest(own, "_other")
    return joined.withColumn("_other", other).withColumn("cell", F.when(F.col("cells").isNull(), F.lit(0)).otherwise(pair).cast("int")).select(*rows.columns)


def links(prints: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) of a spanning forest of each shard's links, from id, print with distinct prints."""
    masks = tables(n, radius)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keyed = prints.select("id", "print", F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(signed(m)).cast("long")).alias("value")) for i, m in enumerate(masks)])).alias("shard"))
    keyed = keyed.select("id", "print", F.xxhash64("shard.table", "shard.value").alias("shard"), F.lit(0).alias("cell"))
    large = shared_checkpoint(keyed.groupBy("shard").count().filter(F.col("count") > RUN).select(F.col("shard").alias("_shard"), F.ceil(F.col("count") / RUN).cast("int").alias("cells")))
    if (many := large.count()):
        keyed = in_cells(keyed.withColumn("cell", F.xxhash64("id")), F.broadcast(large) if many <= SMALL else large, "shard")
    dealt = keyed.repartition(max(12, n * len(masks) // 500_000), "shard", "cell")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(p.num_rows for p in parts):
            return
        table = pa.Table.from_batches(parts)
        ids = np.asarray(table["id"].combine_chunks())
        values = np.asarray(table["print"].combine_chunks()).view(np.uint64)
        shard, cell = (np.asarray(table[c].combine_chunks()) for c in ("shard", "cell"))
        order = np.lexsort((ids, cell, shard))
        ids, values, shard, cell = ids[order], values[order], shard[order], cell[order]
        group = np.cumsum(np.concatenate([[True], (shard[1:] != shard[:-1]) | (cell[1:] != cell[:-1])])) - 1
        size = np.bincount(group)
        alone = size[group] == 1
        ids, values, group = ids[~alone], values[~alone], group[~alone]
        if not len(ids):
            return
        _, group = np.unique(group, return_inverse=True)
        forest = Forest(values, group)
        label = np.arange(len(ids))
        step = 1 << 14
        for a in range(0, len(ids), step):
            for q, found in forest.near(np.arange(a, min(a + step, len(ids))), radius):
                other = q != found
                label = _components(q[other], found[other], label) if other.any() else label
        child = np.flatnonzero(label != np.arange(len(ids)))
        yield pa.record_batch([pa.array(ids[child]), pa.array(ids[label[child]])], ["a", "b"])

    return dealt.mapInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """id, component: the least id reachable, for each id that has an edge; by star contraction with partial aggregation.

    Each round hangs every node's larger neighbours on its least one, then its smaller ones; hubs are
    aggregated before the shuffle and joined by their edges, so no neighbourhood is gathered. Rounds never
    add edges, so the count before one bounds the files that it writes; up to SMALL edges, after they
    are counted, are joined in one task instead, without rounds.
    """
    edges = shared_checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    if state[0] <= SMALL:
        return shared_checkpoint(edges.coalesce(1).mapInArrow(_joined, "id long, component long"))
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # all edges now go from larger to smaller
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = shared_checkpoint(small.filter("a <> b").distinct().coalesce(files(state[0])))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = now


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, component of a whole graph's edges (a, b), but for the least ids."""
    parts = [p for p in batches if p.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    ids, item = np.unique(np.concatenate([table["a"].to_numpy(), table["b"].to_numpy()]), return_inverse=True)
    label = _components(item[: table.num_rows], item[table.num_rows :], np.arange(len(ids)))
    child = np.flatnonzero(label != np.arange(len(ids)))
    yield pa.record_batch([pa.array(ids[child]), pa.array(ids[label[child]])], ["id", "component"])
    release()


def files(rows: int) -> int:
    """Files for so many small rows: a file costs its task a process of the local file system, however little it holds."""
    return max(12, rows // FILE)


def print_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, print, component_id of every row.

    A null, empty or blank text has print 0 and is linked like any other. Equal prints are one node,
    whose id is their least doc_id; rows without an id belong to it too, and have no component_id
    where no row that they reach has an id. Rows that repeat an id each have their own print.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = np.concatenate([fingerprints(part["text"]) for part in chunks(batch)])
            yield pa.record_batch([batch["doc_id"], pa.array(prints.view(np.int64))], ["doc_id", "print"])
        release()

    own = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, print long")
    own = shared_checkpoint(own)
    # nodes are numbered by their least doc_id; a print that only rows without ids have keeps a null id
    nodes = own.groupBy("print").agg(F.min("doc_id").alias("least"))
    nodes = nodes.select("print", "least", F.col("print").alias("id"))
    n = nodes.count()
    joined = components(links(nodes.select("id", "print"), n, radius))
    # only prints with a link meet their component's least id, and a large component's do so in parts
    linked = nodes.join(joined, "id", "left")
    own_least = F.struct(F.col("least").isNull().alias("none"), "least")
    lowest = linked.groupBy(F.coalesce("component", "id").alias("component")).agg(F.min(own_least).alias("row"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    lowest = lowest.select(F.col("component").alias("of"), F.col("row.least").alias("lowest"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("in_part"))
    part = F.pmod(F.xxhash64("print"), F.lit(PARTS)).cast("int")
    named = linked.join(lowest, (F.coalesce("component", "id") == F.col("of")) & (part == F.col("in_part")), "left")
    named = named.select(F.col("print").alias("_print"), F.when(F.col("of").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("component_id"))
    return own.join(named, F.col("print") == F.col("_print")).select("doc_id", "print", "component_id")


def group_digest(docs: DataFrame) -> DataFrame:
    return print_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct shingle hashes, in order, one row after the other, and where each row's end and the next one's begin."""
    hashes, count = shingle_hashes(batch["text"], WORDS)
    row = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(count)))]).astype(np.int64)


def fine_sketch(hashes: np.ndarray) -> bytes:
    """An odd sketch with a power of two of bits, twice the shingles or more; halving it folds it."""
    bits = max(64, 1 << (2 * max(len(hashes), 1) - 1).bit_length())
    odd = np.bincount(((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def coarse_sketch(fine: bytes) -> bytes:
    """A fine sketch folded for the trees; sizes that differ by a factor of two at most do so still."""
    size = min(len(fine), MOST_COARSE, max(LEAST_COARSE, len(fine) // 4))
    return np.bitwise_xor.reduce(np.frombuffer(fine, np.uint8).reshape(-1, size), axis=0).tobytes()


def _differ(one: bytes, two: bytes) -> int:
    """Bits in which two fine sketches differ, at the size of the smaller one."""
    a, b = int.from_bytes(one, "little"), int.from_bytes(two, "little")
    m, n = len(one), len(two)
    while m != n:
        if m < n:
            a, b, m, n = b, a, n, m
        m //= 2
        a = (a >> (8 * m)) ^ (a & ((1 << (8 * m)) - 1))
    return (a ^ b).bit_count()


def _near(sketch, size: np.ndarray, group: np.ndarray, ask: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose sketches, at the size of the smaller one, do not rule them out; by BK-trees for each size.

    With ask, pairs of which no row asks are left out.
    """
    buf, at = flat(sketch)
    words, at = np.frombuffer(buf.tobytes(), np.uint64), at // 8
    width = np.diff(at)
    ask = np.ones(len(width), bool) if ask is None else ask
    for w in np.unique(width).tolist():
        # sets of similar sizes have sketches of one size or its double
        own, twice = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        values = words[at[own][:, None] + np.arange(w)]
        if len(twice):
            folded = words[at[twice][:, None] + np.arange(2 * w)]
            values = np.concatenate([values, folded[:, :w] ^ folded[:, w:]])
        own, exact = np.concatenate([own, twice]), len(own)
        forest = Forest(values, np.unique(group[own], return_inverse=True)[1])
        n, asks = size[own].astype(np.int64), ask[own]
        queries = np.flatnonzero(asks)
        for a in range(0, len(queries), 1 << 12):
            # the other set has at most 5 / 4 of the shingles
            for q, found in forest.near(queries[a : a + (1 << 12)], n // 4):
                ok = (np.minimum(q, found) < exact) & (~asks[found] | (q < found)) & (9 * forest.distance(q, found) <= n[q] + n[found])
                yield own[q[ok]], own[found[ok]]


def _alike(a: np.ndarray, b: np.ndarray, code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the a-th and b-th sets are similar enough; row i has the different codes from at[i] to at[i + 1]."""
    size, most = np.diff(at), int(code.max(initial=0)) + 1
    both = size[a] + size[b]
    part = np.cumsum(both) // (1 << 22)
    common = np.zeros(len(a), np.int64)
    for x in np.split(np.arange(len(a)), np.flatnonzero(np.diff(part)) + 1):
        rows = np.stack([a[x], b[x]], axis=1).ravel()
        many = size[rows]
        place = np.repeat(at[rows] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        key = np.sort(np.repeat(np.arange(len(rows)) // 2, many) * most + code[place])
        common[x] = np.bincount(key[1:][key[1:] == key[:-1]] // most, minlength=len(x))
    return 9 * common >= 4 * both


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many of the sampled texts have, the rarest first, and in about how many rows each is; at most MOST_COMMON reach the driver.

    Any order gives all pairs. With these last, prefixes hold rare shingles and few rows meet.
    """
    every = min(16, max(1, docs.count() // 4096))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch) if batch.num_rows else ():
                yield pa.record_batch([pa.array(shingle_sets(part)[0].view(np.int64))], ["shingle"])
        release()

    some = docs.select("text").filter(F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(every)) == 0).mapInArrow(run, "shingle long")
    rows = some.groupBy("shingle").count().filter(F.col("count") >= COMMON).orderBy(F.desc("count"), "shingle").limit(MOST_COMMON).collect()
    return np.array([r["shingle"] for r in rows[::-1]], np.int64).view(np.uint64), np.array([r["count"] * every for r in rows[::-1]], np.int64)


def nodes_of(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Per row doc_id, same (a hash of its text), node (a hash of its shingle set), size of the set, the set's prefix and sketches.

    Only the first row of a node that a task meets has prefix and sketches.
    """
    rank = np.argsort(common)
    common = common[rank]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch) if batch.num_rows else ():
                hashes, at = shingle_sets(part)
                data, size = hashes.tobytes(), np.diff(at)
                node = np.array([xxhash.xxh64_intdigest(data[8 * a : 8 * b], SEED) for a, b in zip(at, at[1:], strict=False)], np.uint64).view(np.int64)
                level = np.zeros(len(hashes), np.int64)
                if len(common):
                    where = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                    level = np.where(common[where] == hashes, rank[where] + 1, 0)
                row = np.repeat(np.arange(len(size)), size)
                order = np.lexsort((hashes, level, row))
                first = np.zeros(len(size), bool)
                for i, x in enumerate(node.tolist()):
                    first[i] = x not in seen
                    seen.add(x)
                first &= size > 0
                many = np.where(first, size // 5 + 1, 0)
                take = (np.arange(len(row)) - at[row]) < many[row]
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(hashes[order][take].view(np.int64)))
                fine = [fine_sketch(hashes[a:b]) if f else None for a, b, f in zip(at, at[1:], first, strict=False)]
                coarse = [coarse_sketch(x) if x else None for x in fine]
                yield pa.record_batch([part["doc_id"], part["same"], pa.array(node), pa.array(size.astype(np.int32)), prefix, pa.array(fine, pa.binary()), pa.array(coarse, pa.binary())], ["doc_id", "same", "node", "size", "prefix", "fine", "coarse"])
        release()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("same", same())
    return shared_checkpoint(own.mapInArrow(run, "doc_id long, same long, node long, size int, prefix array<long>, fine binary, coarse binary"))


def same() -> Column:
    """A hash of the row's text; with the id it finds the row again."""
    return F.xxhash64(F.col("text").cast("string"), F.lit(SEED))


def _by_run(batches: Iterator[pa.RecordBatch], columns: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, pa.Array | None]:
    """The columns by cell, shingle and node without repeated rows, each row's run of equal cells and shingles, the runs' lengths, and the rows' sketches."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return {c: np.zeros(0, np.int64) for c in columns}, np.zeros(0, np.int64), np.zeros(0, np.int64), None
    table = pa.Table.from_batches(parts)
    own = {c: table[c].to_numpy() for c in columns}
    order = np.lexsort((own["node"], own["shingle"], own["cell"]))
    own = {c: x[order] for c, x in own.items()}
    begin, new = (np.ones(len(order), bool) for _ in range(2))
    begin[1:] = (own["shingle"][1:] != own["shingle"][:-1]) | (own["cell"][1:] != own["cell"][:-1])
    new[1:] = begin[1:] | (own["node"][1:] != own["node"][:-1])
    own, run = {c: x[new] for c, x in own.items()}, (np.cumsum(begin) - 1)[new]
    sketch = table["coarse"].combine_chunks().cast(pa.large_binary()).take(pa.array(order[new])) if "coarse" in table.column_names else None
    return own, run, np.bincount(run), sketch


def _may_be(n: np.ndarray, i: np.ndarray, m: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles that share the i-th and j-th in order can be similar enough."""
    n, i, m, j = (x.astype(np.int64) for x in (n, i, m, j))
    most = np.minimum(i, j) + 1 + np.minimum(n - i, m - j) - 1
    return 9 * most >= 4 * (n + m)


def first_rows(own: DataFrame) -> DataFrame:
    """Per node its row (none, id, same) with the least id, null last, then the least hash of its text; copies are merged before they meet."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "same")
    return shared_checkpoint(own.groupBy("node").agg(F.min(row).alias("row")))


def clusters(found: DataFrame) -> DataFrame:
    """node, component, cluster from node, component, lead: components are one cluster if leads join them."""
    found = shared_checkpoint(found)
    joined = components(found.select(F.col("component").alias("a"), F.col("lead").alias("b"))).select(F.col("id").alias("_id"), F.col("component").alias("cluster"))
    return found.select("node", "component").distinct().join(joined, F.col("component") == F.col("_id"), "left").select("node", "component", F.coalesce("cluster", "component").alias("cluster"))


def by_cluster(rows: DataFrame, most: int, more: DataFrame) -> DataFrame:
    """Rows (node, component, cluster, size) with more's columns, those of a cluster in one task, or in cells if it has over `most` shingles."""
    rows = shared_checkpoint(rows.withColumn("cell", F.lit(0)))
    large = rows.groupBy("cluster").agg(F.sum("size").alias("all")).filter(F.col("all") > most)
    large = shared_checkpoint(large.select(F.col("cluster").alias("_cluster"), F.ceil(F.col("all") / most).cast("int").alias("cells")))
    if (many := large.count()):
        rows = shared_checkpoint(in_cells(rows.withColumn("cell", F.xxhash64("node")), F.broadcast(large) if many <= SMALL else large, "cluster"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    return rows.join(more, "node").repartition(max(12, total // most), "cluster", "cell")


def _in_clusters(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table | None, np.ndarray]:
    """All rows, and the number of each row's cluster and cell."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return None, np.zeros(0, np.int64)
    table = pa.Table.from_batches(parts).combine_chunks()
    cluster, cell = (np.unique(table[c].to_numpy(), return_inverse=True)[1].astype(np.int64) for c in ("cluster", "cell"))
    return table, np.unique(cluster * (int(cell.max()) + 1) + cell, return_inverse=True)[1]


def similar(own: DataFrame, firsts: DataFrame, docs: DataFrame, heavy: list[tuple[int, int]]) -> DataFrame:
    """Edges (a, b) that join the nodes as all pairs with Jaccard similarity >= 0.8 do.

    First each row is compared with two rows of each shingle of its prefix, so that a large group
    is one component without all of its pairs. Then the BK-trees of each shingle with rows of several
    components are asked for what those outside its largest component are near to. Components that
    are near are a cluster; fine sketches and then whole sets, each brought to its cluster once, say
    which of them are one. `heavy` are shingles with the number of cells, over one, into which their
    rows are dealt.
    """
    session = own.sparkSession
    rows = own.select("node", "size", F.posexplode("prefix").alias("at", "shingle"))
    parts = max(12, (own.agg(F.sum(F.size("prefix"))).first()[0] or 0) // 500_000)
    dealt = rows.withColumn("cell", F.lit(0))
    split = session.createDataFrame(heavy, "_shingle long, cells int") if heavy else None
    if split is not None:  # at most MOST_COMMON rows
        dealt = rows.join(F.broadcast(split), F.col("shingle") == F.col("_shingle"), "left").withColumn("cell", F.coalesce(F.pmod(F.xxhash64("node"), F.col("cells")), F.lit(0)).cast("int")).drop("_shingle", "cells")
    columns = ["cell", "shingle", "node", "size", "at"]
    ddl = "cell int, shingle long, node long, size int, at int"

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, run, length, _ = _by_run(batches, columns)
        if not len(run):
            return
        stop = np.cumsum(length)
        leads, met = [], np.zeros(len(run), bool)
        for lead in ((stop - length)[run], (stop - 1)[run]):  # the second only where the first cannot be
            ok = _may_be(x["size"], x["at"], x["size"][lead], x["at"][lead]) & (x["node"] != x["node"][lead]) & ~met
            leads.append(pa.array(x["node"][lead], mask=~ok))
            met |= ok
        # a run of two has no pair but that of its leads
        many = (length[run] > 2) | np.isin(x["shingle"], np.array([h for h, _ in heavy], np.int64))
        out = pa.record_batch([*(pa.array(x[c]) for c in columns), *leads, pa.array(many)], [*columns, "lead", "other", "many"])
        yield out.filter(pa.array(many | ~np.logical_and(*(lead.is_null().to_numpy(zero_copy_only=False) for lead in leads))))
        release()

    runs = shared_checkpoint(dealt.repartition(parts, "cell", "shingle").mapInArrow(shared, f"{ddl}, lead long, other long, many boolean"))
    pairs = runs.select("node", F.explode(F.array("lead", "other")).alias("lead")).filter("lead is not null")
    if split is not None:  # all cells of a shingle also meet its two leads
        ends = runs.join(F.broadcast(split), F.col("shingle") == F.col("_shingle")).groupBy("_shingle").agg(F.array(F.min("node"), F.max("node")).alias("ends"))
        pairs = pairs.unionAll(runs.join(F.broadcast(ends), F.col("shingle") == F.col("_shingle")).select("node", F.explode("ends").alias("lead")).filter("node <> lead"))
    prints = own.filter("fine is not null")
    fine = prints.select("node", F.col("size").alias("n"), "fine").dropDuplicates(["node"])

    def close(pairs: DataFrame) -> DataFrame:
        """The pairs whose sketches do not rule them out."""
        both = pairs.join(fine.withColumnsRenamed({"node": "a", "n": "n_a", "fine": "one"}), "a").join(fine.withColumnsRenamed({"node": "b", "n": "n_b", "fine": "two"}), "b")

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy()
                differ = np.fromiter((_differ(x, y) for x, y in zip(batch["one"].to_pylist(), batch["two"].to_pylist(), strict=True)), np.int64, batch.num_rows)
                yield batch.select(["a", "b"]).filter(pa.array(9 * differ <= sizes))

        return both.mapInArrow(near, "a long, b long")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """node and items, its whole set, from the text of its first row."""
        one = firsts.join(nodes, "node", "left_semi").select("node", F.when(~F.col("row.none"), F.col("row.id")).alias("_id"), F.col("row.same").alias("_same"))
        one = shared_checkpoint(one)
        if one.count() <= SMALL:
            one = F.broadcast(one)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("same", same())
        texts = texts.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("same") == F.col("_same")))
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))  # equal rows are merged before the shuffle
        return shared_checkpoint(texts.mapInArrow(whole, "node long, items array<long>"))

    def exact(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, by their sets."""
        pairs = shared_checkpoint(close(pairs))
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        left, right = sets.select(F.col("node").alias("a"), F.col("items").alias("one")), sets.select(F.col("node").alias("b"), F.col("items").alias("two"))
        both = pairs.join(left, "a").join(right, "b")
        return shared_checkpoint(both.filter(9 * F.size(F.array_intersect("one", "two")) >= 4 * (F.size("one") + F.size("two"))).select("a", "b"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch) if batch.num_rows else ():
                hashes, at = shingle_sets(part)
                yield pa.record_batch([part["node"], pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))], ["node", "items"])
        release()

    edges = exact(pairs.select(F.greatest("node", "lead").alias("a"), F.least("node", "lead").alias("b")).distinct())

    wide = [*columns, "component"]

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, run, length, sketch = _by_run(batches, wide)
        if not len(run):
            return
        # each run's largest component only answers
        order = np.lexsort((x["component"], run))
        new = np.ones(len(order), bool)
        new[1:] = (run[order][1:] != run[order][:-1]) | (x["component"][order][1:] != x["component"][order][:-1])
        part = np.empty(len(order), np.int64)
        part[order] = np.cumsum(new) - 1
        size = np.bincount(part)
        of = run[order][new]
        largest = np.lexsort((size, of))
        largest = largest[np.append(of[largest][1:] != of[largest][:-1], True)]
        ask = np.flatnonzero(part != largest[run])
        mixed = np.zeros(len(length), bool)
        mixed[run[ask]] = True
        if not len(ask):
            return
        left = np.flatnonzero(mixed[run])
        asks = np.zeros(len(run), bool)
        asks[ask] = True
        n, at, component = (x[c][left].astype(np.int64) for c in ("size", "at", "component"))
        names, item = np.unique(component, return_inverse=True)
        met = np.zeros(len(left), bool)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for q, found in _near(sketch.take(pa.array(left)), n, run[left], asks[left]):
                ok = (component[q] != component[found]) & _may_be(n[q], at[q], n[found], at[found])
                met[q[ok]] = met[found[ok]] = True
                yield q[ok], found[ok]

        lead = names[_merge(pairs(), item)]
        node, first = np.unique(x["node"][left][met], return_index=True)
        own = np.flatnonzero(met)[first]
        yield pa.record_batch([pa.array(node), pa.array(component[own]), pa.array(lead[item[own]])], ["node", "component", "lead"])
        release()

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, group = _in_clusters(batches)
        if table is None:
            return
        size, component, node = (table[c].to_numpy().astype(np.int64) for c in ("size", "component", "node"))
        names, item = np.unique(component, return_inverse=True)
        met = np.zeros(len(node), bool)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for q, found in _near(table["fine"], size, group):
                ok = component[q] != component[found]
                met[q[ok]] = met[found[ok]] = True
                yield q[ok], found[ok]

        lead = names[_merge(pairs(), item)]
        yield pa.record_batch([pa.array(node[met]), pa.array(component[met]), pa.array(lead[item[met]])], ["node", "component", "lead"])
        release()

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, group = _in_clusters(batches)
        if table is None:
            return
        items = table["items"].combine_chunks()
        at = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy().astype(np.int64))])
        hashes = items.flatten().to_numpy().view(np.uint64)
        names, item = np.unique(table["component"].to_numpy(), return_inverse=True)
        code = np.unique(hashes, return_inverse=True)[1]
        pairs = _near(pa.array([fine_sketch(hashes[a:b]) for a, b in itertools.pairwise(at.tolist())], pa.binary()), np.diff(at), group)
        label = _merge(pairs, item, lambda a, b: _alike(a, b, code, at))
        child = np.flatnonzero(label != np.arange(len(label)))
        yield pa.record_batch([pa.array(names[child]), pa.array(names[label[child]])], ["a", "b"])
        release()

    joined = components(edges).withColumnRenamed("id", "node")
    many = runs.filter("many").select(*columns)
    if split is not None:
        many = in_cells(many, F.broadcast(split), "shingle")
    many = many.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).join(prints.select("node", "coarse").dropDuplicates(["node"]), "node").select(*wide, "coarse")
    named = "node long, component long, lead long"
    found = clusters(many.repartition(max(12, parts // 4), "cell", "shingle").mapInArrow(trees, named))
    # a fine sketch has a sixteenth of its set's bytes at most
    found = by_cluster(found.join(fine.select("node", F.col("n").alias("size")), "node"), 8 * CUT, fine.select("node", "fine"))
    found = shared_checkpoint(clusters(found.mapInArrow(finer, named)))
    sets = sets_of(found.select("node"))
    found = by_cluster(found.join(sets.select("node", F.size("items").alias("size")), "node"), CUT, sets)
    return edges.unionAll(shared_checkpoint(found.mapInArrow(decided, "a long, b long")))


def similar_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node and its first row; and node, component of the nodes with an edge. Rows without words have the empty set and are one node."""
    common, often = common_shingles(docs)
    own = nodes_of(docs, common)
    heavy = [(int(h), int(-(-n // RUN))) for h, n in zip(common.view(np.int64), often, strict=True) if n > RUN]
    firsts = first_rows(own)
    return firsts, components(similar(own, firsts, docs, heavy)).withColumnRenamed("id", "node")


def keepers(docs: DataFrame) -> DataFrame:
    """One row (_none, _id, _same) for each group of similar shingle sets: its row with the least id, null last, then the least hash of its text."""
    firsts, nodes = similar_groups(docs)
    lowest = firsts.join(nodes, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("row").alias("row"))
    return lowest.select(F.col("row.none").alias("_none"), F.col("row.id").alias("_id"), F.col("row.same").alias("_same"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, in the columns of documents, that stand for their group of similar shingle sets.

    A group's row is the one with the smallest doc_id, null last; among rows that repeat that id, the
    one whose text has the least hash. Each group keeps exactly one row, whatever its ids: rows that
    repeat an id but are not similar all stay, each for its own group. Of equal rows one stays; where
    rows agree on id and text, the least of the other columns counts. Texts without words (null, empty
    or blank) are one group. Very long texts have as many shingles as words; their sets are whole.
    """
    columns = ["text", "lang", "source", "n_chars"]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    own = own.withColumns({"_none": F.col("doc_id").isNull(), "_id": F.coalesce("doc_id", F.lit(0)), "_same": same()})
    # equal rows are merged before the shuffle; the join's and the aggregate's keys are alike, so texts are shuffled once
    rows = own.groupBy("_none", "_id", "_same").agg(F.min(F.struct("doc_id", *columns)).alias("_row"))
    return rows.join(keepers(docs), ["_none", "_id", "_same"]).select("_row.*")
