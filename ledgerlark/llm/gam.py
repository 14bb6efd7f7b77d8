"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: in turn, every feature gets a shallow regression tree on the current gradient, and
the trees of a feature add up to one lookup table over its bins. Then pairs whose bins best explain
what is left get tables in two dimensions in the same way. A score is the logistic of the sum of one
number per table, picked by bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import IS_WORD, flat, held_out, release, sorted_set, word_bounds
from ledgerlark.llm.windows import _BYTE, mixed

#: Labelled rows to learn from, at most: those with the least hash of their id. The one bound of this operator.
SAMPLE = 20_000
THRESHOLD = 0.3
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, LEAVES, RATE, RIDGE = 32, 8, 60, 20, 6, 3, 0.2, 2.0
CHUNK = 1 << 20

_CLASS = np.zeros((7, 256), bool)  # capitals, letters, digits, marks of a sentence, table bars, other symbols, beyond ASCII
_CLASS[0, 0x41:0x5B] = True
_CLASS[1, [*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CLASS[2, 0x30:0x3A] = True
_CLASS[3, list(b".,;:?")] = True
_CLASS[4, list(b"|\t")] = True
_CLASS[5, list(b"!#$%&*+/<=>@[]\\^_`{}~\"")] = True
_CLASS[6, 0x80:] = True
FEATURES = ("log_bytes", "log_words", "word_length", "capitals", "digits", "marks", "bars", "symbols", "beyond_ascii", "repeats_before", "distinct_words", "most_frequent_word", "line_length", "distinct_lines", "long_words", "blank")


def features(column) -> np.ndarray:
    """One row of FEATURES per text; nothing else of a document is looked at. Empty texts have their own values, 0."""
    buf, at = flat(column)
    n = len(at) - 1
    size = np.diff(at)
    total = np.maximum(size, 1)
    have = np.flatnonzero(size)

    def sums(x: np.ndarray, bounds: np.ndarray = at) -> np.ndarray:
        out = np.zeros(n)
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            out[some] = np.add.reduceat(x, bounds[:-1][some], dtype=np.int64)
        return out

    classes = [sums(_CLASS[i][buf]) for i in range(7)]
    # capitals of Latin-1 count too
    after = np.zeros(len(buf), bool)
    after[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    capitals = classes[0] + sums(after)
    starts, ends, first = word_bounds(buf, at)
    words = np.diff(first)
    some_words = np.maximum(words, 1)
    length = ends - starts
    row = np.repeat(np.arange(n), words)

    def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(a):
            return np.zeros(0, np.uint64)
        run = b - a
        rel = np.arange(int(run.sum())) - np.repeat(np.cumsum(run) - run, run)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(run.max()), np.uint64(0x9E3779B97F4A7C15))]).astype(np.uint64))
        return mixed(np.add.reduceat(_BYTE[buf[np.repeat(a, run) + rel]] * power[rel], np.cumsum(run) - run))

    def distinct(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of each row, and the count of the most frequent one."""
        order = np.lexsort((h, rows))
        h, rows = h[order], rows[order]
        at_ = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])])) if len(h) else np.zeros(0, np.int64)
        count = np.diff(np.append(at_, len(h)))
        most = np.zeros(n)
        np.maximum.at(most, rows[at_], count)
        return np.bincount(rows[at_], minlength=n), most

    word_hash = hashes(starts, ends)
    same = np.zeros(len(word_hash), bool)
    same[1:] = (word_hash[1:] == word_hash[:-1]) & (row[1:] == row[:-1])
    kinds, most = distinct(word_hash, row)
    newline = np.flatnonzero(buf == 10)
    line_start = sorted_set(at[:-1][have], newline + 1)
    line_start = line_start[line_start < len(buf)]
    line_end = np.append(line_start[1:], len(buf))
    line_row = np.searchsorted(at, line_start, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    line_kinds, _ = distinct(hashes(line_start, line_end), line_row)
    letters = np.maximum(classes[1] + classes[6] / 2, 1)
    out = np.stack([
        np.log1p(size), np.log1p(words), sums(length, first) / some_words, capitals / letters, classes[2] / total, classes[3] / some_words, classes[4] / some_words, classes[5] / some_words,
        classes[6] / total, sums(same, first) / some_words, kinds / some_words, most / some_words, size / np.maximum(lines, 1), line_kinds / np.maximum(lines, 1), sums(length > 20, first) / some_words, 1 - sums(IS_WORD[buf]) / total,
    ], axis=1)
    out[size == 0] = 0
    return out


@dataclass
class Model:
    """edges[i]: bounds of feature i's bins; tables[i]: a number per bin; pairs: (i, j, their bounds, table)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, i], "right")]
        for i, j, a, b, table in self.pairs:
            total += table[np.searchsorted(a, x[:, i], "right"), np.searchsorted(b, x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Bounds between quantiles, halfway between neighbouring values."""
    values = np.unique(x)
    if len(values) < 2:
        return np.zeros(0)
    at = np.unique(np.searchsorted(values, np.quantile(x, np.arange(1, bins) / bins)))
    at = at[(at > 0) & (at < len(values))]
    return (values[at - 1] + values[at]) / 2


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree of few leaves over bins in order, with gradient and curvature sums g and h: the step of each bin."""
    gain = lambda a, b: (g[a:b].sum() ** 2) / (h[a:b].sum() + RIDGE)
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((gain(a, c) + gain(c, b) - gain(a, b), a, c, b) for a, b in parts for c in range(a + 1, b)), default=(0, 0, 0, 0))
        if best[0] <= 1e-9:
            break
        _, a, c, b = best
        parts.remove((a, b))
        parts += [(a, c), (c, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one-feature trees, then of trees over the bins of chosen pairs. Without rows, or with one label only, the score is constant."""
    rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    model = Model(float(np.log(rate / (1 - rate))), [_edges(x[:, i], BINS) for i in range(x.shape[1])], [], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not len(y) or len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, b in enumerate(bins):
            g, h = slopes()
            m = len(model.tables[i])
            step = RATE * _tree(np.bincount(b, g, m), np.bincount(b, h, m), LEAVES)
            model.tables[i] += step
            total += step[b]
    coarse = [_edges(x[:, i], PAIR_BINS) for i in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(coarse)]
    g, h = slopes()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            m = len(coarse[j]) + 1
            cell, n = cells[i] * m + cells[j], (len(coarse[i]) + 1) * m
            ranked.append((float((np.bincount(cell, g, n) ** 2 / (np.bincount(cell, h, n) + RIDGE)).sum()), i, j))
    chosen = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in sorted(ranked, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, table in chosen:
            g, h = slopes()
            cell = cells[i] * table.shape[1] + cells[j]
            gs, hs = (np.bincount(cell, v, table.size).reshape(table.shape) for v in (g, h))
            # a tree of depth two: a split of i, and one of j on each side
            step = np.zeros_like(table)
            side = _tree(gs.sum(axis=1), hs.sum(axis=1), 2)
            for value in np.unique(side):
                rows = side == value
                step[rows] = _tree(gs[rows].sum(axis=0), hs[rows].sum(axis=0), 2)
            table += RATE * step
            total += RATE * step[cells[i], cells[j]]
    model.pairs = chosen
    return model


def _chunked(batch: pa.RecordBatch):
    size = np.cumsum(np.diff(flat(batch["text"])[1]))
    at = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(at, at[1:], strict=False):
        yield batch.slice(a, b - a)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled rows that are not held out: those with the least hashes of
    their ids, rows that repeat an id by their features. Rows without a label or id teach nothing; of
    several labels of an id the largest counts. Without any label the score is constant.
    """
    known = labels.selectExpr("cast(doc_id as long) _id", "cast(quality as int) quality").filter(F.col("_id").isNotNull() & F.col("quality").isNotNull())
    known = known.filter(~held_out("_id")).groupBy("_id").agg(F.max("quality").alias("quality"))
    few = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("text", "quality", F.xxhash64("_id").alias("key"), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(batch):
                x = features(part["text"])
                yield pa.record_batch([pa.array(list(x)), part["quality"], part["key"], part["_id"]], ["x", "y", "key", "id"])

    # repeated ids multiply rows: the bound holds for the rows themselves
    got = rows.mapInArrow(run, "x array<double>, y int, key long, id long").orderBy("key", "id", "x").limit(sample).select("x", "y").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = np.array(got["y"].to_pylist(), float)
    order = np.lexsort((y, *x.T))  # the same model however the rows arrive
    return fit(x[order], (y[order] > 0).astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its text alone; a null text counts as empty.

    Rows that repeat an id are scored each by itself; a very long text's features are those of all of
    it. An empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tables, whatever the input's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(batch):
                yield pa.record_batch([part["doc_id"], part["held_out"], pa.array(shared.value.score(features(part["text"])))], ["doc_id", "held_out", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    rows = own.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return rows.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, in the columns of documents, whose score reaches the threshold; equal texts all stay or all go."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(batch):
                yield part.filter(pa.array(shared.value.score(features(part["text"])) >= THRESHOLD))
        release()

    own = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "cast(lang as string) lang", "cast(source as string) source", "cast(n_chars as long) n_chars")
    return own.select(*columns).mapInArrow(run, own.schema)
