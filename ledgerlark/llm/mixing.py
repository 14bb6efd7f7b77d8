"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents are dealt to blocks by a hash. Its target is met by whole passes over its
blocks and one part pass over the first ones of a permuted order; the last block of that pass gives
documents, in a hashed order, up to the one that comes nearest. That makes an exact quota of block
copies for each source. The tree splits the quotas among the output shards: each node draws how many
of each source's copies go left, by a multivariate hypergeometric draw whose seed is the node's
place. A shard then draws as many blocks of each source as its quota says, the next ones of the
permuted order, so shards are disjoint and together take every copy once; what a document gives is
what the shards drew of its block. A shard is one partition of the mix, shuffled inside. A rerun
draws the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import WORD, shared_checkpoint

SEED, REPEATS = 20240229, 3
WEIGHTS = (1, 2, 3)
#: Documents of a block, about, and the least number of blocks of a source.
BLOCK_DOCS, LEAST_BLOCKS = 1000, 64
#: Shards at least, and words of a shard, about.
SHARDS, SHARD_WORDS = 16, 1 << 24
#: Numbers in the table of quotas, a row per shard and a column per source, that is broadcast; with more, shards are larger.
QUOTAS = 1 << 24
#: Copies that one draw splits; numpy's takes less than 10^9. More are drawn in equal layers.
DRAW = 1 << 29
#: Rows that are made from one row at a time.
ROWS = 1 << 16
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def targets(sizes: DataFrame) -> DataFrame:
    """source, place, source_size, target from source, source_size: weights in turn by code point, null last.

    Targets are min(REPEATS * size, level * weight) with the one level at which they add up to all
    sizes; that is where sharing the excess again and again ends.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")))
    rows = rows.withColumn("cap", REPEATS * F.col("source_size")).withColumn("at", F.col("cap") / F.col("weight"))
    whole = Window.orderBy("at", F.asc_nulls_last("source"))
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # the level if this source and those after it are not capped; the first row where that holds has the right one
    rows = rows.withColumn("level", left / weight)
    rows = rows.withColumn("level", F.coalesce(F.min(F.when(F.col("level") <= F.col("at"), F.struct("at", "level"))).over(every)["level"], F.lit(0.0)))
    return rows.select("source", "place", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _draw(rng: np.random.Generator, have: np.ndarray, take: int) -> np.ndarray:
    """How many of each source are among `take` copies drawn of all; in layers of equal shares where they are too many."""
    total = int(have.sum())
    layers = -(-total // DRAW)
    if layers <= 1:
        return rng.multivariate_hypergeometric(have, take, method="marginals") if take else np.zeros_like(have)
    out, left = np.zeros_like(have), have.copy()
    for i in range(layers, 0, -1):
        layer = left // i
        own = min(take // i if i > 1 else take, int(layer.sum()))
        out += _draw(rng, layer, own)
        left -= layer
        take -= own
    return out


def split(counts: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """counts[i] copies of source i among the shards: one row a shard, exact in both directions."""
    out = np.zeros((shards, len(counts)), np.int64)
    stack = [(0, shards, counts.astype(np.int64))]
    while stack:
        lo, hi, have = stack.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        take = int(have.sum()) * (mid - lo) // (hi - lo)
        left = _draw(np.random.Generator(np.random.PCG64([seed, lo, hi])), have, take)
        stack += [(lo, mid, left), (mid, hi, have - left)]
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and two hashes of the whole row: equal rows, and only those, share both."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    parts = [c for name in COLUMNS for c in (F.col(name), F.col(name).isNull())]  # hashes skip nulls
    return own.select("*", F.xxhash64(*parts, F.lit(SEED)).alias("_h"), F.xxhash64(F.lit(SEED), *parts).alias("_g"))


def plan(docs: DataFrame, shards: int | None = None) -> tuple[DataFrame, int]:
    """A table of the distinct rows, by their hashes _h and _g: doc_id, size, rows, source_size, target, `shards`, `some`; and the number of shards.

    shards[p] is the shard that drew the copy of the row's block in pass p; the last one is the part
    pass if `parted`, and gives `some` of the equal rows, all others give each row.

    A null or empty text has size 0 and is never drawn; null sources are one source, last in order.
    Rows that repeat an id are planned each by its own text and columns; equal rows are planned
    together. A very long text counts all its words, and its whole document is taken or not. Columns
    beyond those of documents are not read. An empty table gives no rows. A row per source and the table of quotas reach the driver; nothing else does.
    """
    session = docs.sparkSession
    sized = _keyed(docs).select("_h", "_g", "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = shared_checkpoint(sized.groupBy("_h", "_g").agg(F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.max("size").alias("size"), F.count(F.lit(1)).alias("rows")))
    n, words = sized.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum(F.col("size") * F.col("rows")), F.lit(0))).first()
    blocks = max(LEAST_BLOCKS, n // BLOCK_DOCS)
    sized = sized.withColumn("block", F.pmod("_h", F.lit(blocks)))

    per_block = sized.groupBy("source", "block").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
    # the permuted order is that of a hash; it is cut in stretches, so that no source's blocks meet in one task
    spread = F.xxhash64("block", F.lit(SEED))
    bits = max(1, blocks.bit_length() // 2)
    per_block = shared_checkpoint(per_block.select("*", spread.alias("spread"), F.shiftrightunsigned(spread, 64 - bits).alias("stretch")))
    stretches = per_block.groupBy("source", "stretch").agg(F.sum("words").alias("all_words"), F.count(F.lit(1)).alias("all_blocks"))
    goal = targets(stretches.groupBy("source").agg(F.sum("all_words").alias("source_size"), F.sum("all_blocks").alias("blocks")).select("source", "source_size"))
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    along = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("source", "stretch", F.coalesce(F.sum("all_words").over(along), F.lit(0)).alias("words_before"), F.coalesce(F.sum("all_blocks").over(along), F.lit(0)).alias("blocks_before"), F.sum("all_blocks").over(Window.partitionBy("source")).alias("blocks"))
    stretches = stretches.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    stretches = stretches.withColumnsRenamed({"source": "of", "stretch": "in_stretch"})
    table = per_block.join(stretches, F.col("source").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("in_stretch"))).drop("of", "in_stretch")
    order = Window.partitionBy("source", "stretch").orderBy("spread", "block")
    before = F.col("words_before") + F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = table.withColumn("rank", F.col("blocks_before") + F.row_number().over(order) - 1).withColumn("part", F.col("rest") - before)
    table = shared_checkpoint(table.select("source", "block", "place", "source_size", "target", "whole", "blocks", "rank", "part", (F.col("part") > 0).alias("parted")))

    # the tree over exact quotas of block copies
    rows = table.groupBy("place").agg(F.sum(F.col("whole") + F.col("parted").cast("long")).alias("copies")).orderBy("place").collect()
    shards = shards or shard_count(words, len(rows))
    quotas = split(np.array([r["copies"] for r in rows], np.int64), shards)
    ends = session.sparkContext.broadcast(np.ascontiguousarray(np.cumsum(quotas, axis=0).T))  # at most QUOTAS numbers

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, whole, blocks, rank, parted = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "whole", "blocks", "rank", "parted"))
            many = whole + parted
            row = np.repeat(np.arange(len(many)), many)
            copy = rank[row] + blocks[row] * (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
            shard = np.full(len(row), shards, np.int64)
            for i in np.unique(place[row]).tolist():
                own = place[row] == i
                shard[own] = np.searchsorted(ends.value[i], copy[own], "right")
            # a copy that no shard's quota reaches is not drawn
            shard = pa.array(shard, pa.int64(), mask=shard >= shards)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), shard)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in carried), lists], [*carried, "shards"])

    carried = ["source", "block", "source_size", "target", "part", "parted"]
    drawn = table.mapInArrow(draw, "source string, block long, source_size long, target double, part long, parted boolean, shards array<long>")
    drawn = drawn.withColumnsRenamed({"source": "of", "block": "in_block"})
    rows = sized.join(drawn, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in_block")))
    # only in the block where the part pass ends does the order of its rows tell which are taken
    within = Window.partitionBy("source", "block").orderBy(F.xxhash64("_h", F.lit(1)), "_h", "_g")
    before = F.coalesce(F.sum(F.col("size") * F.col("rows")).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = F.greatest(F.least(F.round((F.col("part") - before) / F.greatest("size", F.lit(1))).cast("long"), F.col("rows")), F.lit(0))
    return rows.select("_h", "_g", "doc_id", "size", "rows", "source_size", "target", "parted", "shards", some.alias("some")), shards


def shard_count(words: int, sources: int) -> int:
    """One shard for SHARD_WORDS words, SHARDS at least, fewer where the quotas' table would be larger than QUOTAS."""
    return max(1, min(max(SHARDS, -(-words // SHARD_WORDS)), QUOTAS // max(1, sources)))


def _numbered(rows: DataFrame, many: Column) -> DataFrame:
    """Each row `many` times, numbered in `row` from 0; ROWS numbers at a time are made."""
    rows = rows.withColumn("_many", many).filter("_many > 0")
    rows = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_many") - 1, F.lit(ROWS).cast("long"))))
    return rows.withColumn("row", F.explode(F.sequence("_from", F.least(F.col("_from") + ROWS, F.col("_many")) - 1))).drop("_many", "_from")


def mix(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The documents as often as the shards drew them, in the columns of documents; texts are whole.

    Partition i is shard i: its rows are the blocks that it drew, shuffled by a hash. Equal rows are
    drawn together, each as often as planned; rows that only share an id are drawn by themselves.
    Documents without words (null, empty or blank) stay once each: no target counts them. An empty
    table gives no rows.
    """
    chosen, shards = plan(docs, shards)
    # equal rows are merged before the shuffle; the join's and the aggregate's keys are alike, so texts are shuffled once
    own = _keyed(docs).groupBy("_h", "_g").agg(F.first(F.struct(*COLUMNS)).alias("_row"))
    rows = own.join(chosen.select("_h", "_g", "size", "rows", "parted", "some", "shards"), ["_h", "_g"])
    passes = F.posexplode(F.when(F.col("size") == 0, F.array(F.pmod("_h", F.lit(shards)))).otherwise(F.col("shards"))).alias("_pass", "_shard")
    rows = rows.select("*", passes).filter("_shard is not null")
    in_part = F.col("parted") & (F.col("_pass") == F.size("shards") - 1) & (F.col("size") > 0)
    rows = _numbered(rows, F.when(in_part, F.col("some")).otherwise(F.col("rows")))
    rows = rows.select("_row.*", F.col("_shard").cast("int").alias("_shard"), F.xxhash64("_h", "_g", "_pass", "row").alias("_at"))
    return rows.repartitionById(shards, F.col("_shard")).sortWithinPartitions("_at").drop("_shard", "_at")


def mix_digest(docs: DataFrame) -> DataFrame:
    """Per document what the shards took of it: doc_id, size, source_size, target, taken, and the shards of its copies."""
    rows = _numbered(plan(docs)[0], F.col("rows"))
    kept = F.filter("shards", lambda s, p: s.isNotNull() & ~(F.col("parted") & (p == F.size("shards") - 1) & (F.col("row") >= F.col("some"))))
    rows = rows.withColumn("shards", F.when(F.col("size") > 0, kept).otherwise(F.array().cast("array<long>")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")
