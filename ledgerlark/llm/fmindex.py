"""Substring dedup over words: a compressed FM-index per shard and backward search by wavelet trees.

A shard's texts become one sequence of word numbers. Of its Burrows-Wheeler transform the index keeps
a wavelet matrix: one bit vector per level with counts per 64 bits, so a rank costs one word and one
count a level; and every SAMPLE-th place of the sequence, marked by a bit vector over the ranks. The
suffix array itself is not kept: a place is found by going back to the next sample. The documents'
pieces are streamed through the index: for each word the backward search from it gives the matching
statistic, the length up to which what ends there occurs elsewhere too, and the interval of those
occurrences. Intervals of the threshold length are reported with the least id in them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlark.llm.windows import covered, word_tokens

LENGTH = 13
GRAM = 5
#: A place in so many of the sequence is kept.
SAMPLE = 8


class FMIndex:
    """Over a sequence in which 0 ends each text and words count from 1."""

    def __init__(self, seq: np.ndarray) -> None:
        n = len(seq)
        ends = seq == 0
        rank = np.where(ends, np.cumsum(ends) - 1, seq + ends.sum())  # each end is a symbol of its own
        sa, step = np.argsort(rank, kind="stable"), 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[:-step or None] = rank[step:] + 1
            follow[ends] = 0
            key = rank * np.int64(rank.max() + 2) + np.where(ends, 0, follow)
            sa = np.argsort(key)
            ordered = key[sa]
            rank = np.empty(n, np.int64)
            rank[sa] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            if rank[sa[-1]] == n - 1:
                break
            step *= 2
        symbols = int(seq.max()) + 1
        self.levels = max(1, int(symbols - 1).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])
        self.bits, self.counts, self.zeros = [], [], []
        left = seq[sa - 1]
        for level in range(self.levels - 1, -1, -1):
            bit = ((left >> level) & 1).astype(bool)
            packed, counts = _ranked(bit)
            self.bits.append(packed)
            self.counts.append(counts)
            self.zeros.append(n - int(bit.sum()))
            left = np.concatenate([left[~bit], left[bit]])
        first = np.zeros(symbols, np.int64)
        at = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
        first[left[at]] = at
        self.shift = self.before[:-1] - first
        sampled = (sa % SAMPLE == 0) | np.concatenate([[True], ends[:-1]])[sa]  # and where a text begins
        self.samples = sa[sampled].astype(np.int32)
        self.marked, self.marks_before = _ranked(sampled)

    def _ones(self, bits: np.ndarray, counts: np.ndarray, pos: np.ndarray) -> np.ndarray:
        cell = pos >> 6
        return counts[cell] + np.bitwise_count(bits[cell] & ((np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)))

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The array index before which all suffixes `symbol` + (suffixes before `at`) stand."""
        pos = at
        for level in range(self.levels):
            ones = self._ones(self.bits[level], self.counts[level], pos)
            pos = np.where((symbol >> (self.levels - 1 - level)) & 1 == 1, self.zeros[level] + ones, pos - ones)
        return self.shift[symbol] + pos

    def previous(self, rank: np.ndarray) -> np.ndarray:
        """The rank of the suffix one word longer."""
        pos, symbol = rank, np.zeros(len(rank), np.int64)
        for level in range(self.levels):
            bit = ((self.bits[level][pos >> 6] >> (pos & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(self.bits[level], self.counts[level], pos)
            symbol = symbol << 1 | bit
            pos = np.where(bit == 1, self.zeros[level] + ones, pos - ones)
        return self.shift[symbol] + pos

    def places(self, rank: np.ndarray) -> np.ndarray:
        """Where the suffixes of these ranks begin: back to the next sample. No walk leaves its text, whose first place is a sample."""
        out, steps = np.empty(len(rank), np.int64), 0
        left = np.arange(len(rank))
        while len(left):
            hit = ((self.marked[rank >> 6] >> (rank & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            out[left[hit]] = self.samples[self._ones(self.marked, self.marks_before, rank[hit])] + steps
            left, rank, steps = left[~hit], rank[~hit], steps + 1
            if len(left):
                rank = self.previous(rank)
        return out


def _ranked(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits packed, and how many are set before each 64 of them."""
    packed = np.packbits(np.concatenate([bit, np.zeros(64 + -len(bit) % 64, bool)]), bitorder="little").view(np.uint64)
    return packed, np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32)


def statistics(index: FMIndex, seq: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place `last` of the streamed sequence: how many of the words that end there, up to `length`,
    also occur elsewhere in the index, and the interval of ranks of those that reach `length` (else empty)."""
    lo_out, hi_out = np.zeros(len(last), np.int64), np.zeros(len(last), np.int64)
    matched = np.full(len(last), length, np.int64)
    live, symbol = np.arange(len(last)), seq[last]
    lo, hi = index.before[symbol], index.before[symbol + 1]
    for step in range(1, length + 1):
        several = hi - lo > 1  # one occurrence: the streamed words themselves
        matched[live[~several]] = step - 1
        live, lo, hi = live[several], lo[several], hi[several]
        if not len(live) or step == length:
            break
        symbol = seq[last[live] - step]
        both = index.back(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        lo, hi = both[: len(live)], both[len(live) :]
    lo_out[live], hi_out[live] = lo, hi
    return matched, lo_out, hi_out


def least_ids(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each text, the least id over all texts that hold it; and each text's number of windows."""
    numbers: dict[bytes, int] = {b"\n": 0}
    words = (b" \n ".join(texts) + b" \n").split(b" ")
    seq = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    stop = np.flatnonzero(seq == 0)
    begin = np.concatenate([[0], stop[:-1] + 1])
    count = stop - begin - length + 1
    place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    out = np.repeat(ids, count)
    index = FMIndex(seq)
    matched, lo, hi = statistics(index, seq, place + length - 1, length)
    live = np.flatnonzero(matched == length)
    if len(live):
        # equal windows have one interval; their occurrences are found once
        left, at, which = np.unique(lo[live], return_index=True, return_inverse=True)
        size = hi[live][at] - left
        first = np.cumsum(size) - size
        ranks = np.repeat(left - first, size) + np.arange(int(size.sum()))
        owner = np.searchsorted(stop, index.places(ranks))
        out[live] = np.minimum.reduceat(ids[owner], first)[which]
    return out, count


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digest(table: pa.Table, t, removed: np.ndarray) -> pa.Table:
    first = t.first
    size = np.diff(t.begin(np.arange(t.n + 1))) if t.n else np.zeros(0, np.int64)
    kept = t.text[np.repeat(~removed, size)].tobytes()
    place = np.concatenate([[0], np.cumsum(np.where(removed, 0, size))])[first].tolist()
    total = np.concatenate([[0], np.cumsum(removed)])
    return pa.table({
        "doc_id": table["doc_id"], "n_words": np.diff(first), "n_removed": np.diff(total[first]),
        "kept_sha256": [hashlib.sha256(kept[a : max(a, b - 1)]).hexdigest() for a, b in zip(place, place[1:], strict=False)],
    }, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


def dedup_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: words, words that a `length`-word window of a smaller doc_id covers, and what is left as a digest.

    A null text has no words; a text of fewer than `length` words keeps all. A null doc_id counts as
    larger than any other. Rows that repeat an id never remove from each other. A very long text is in
    one bucket and streamed in pieces like any other; no window of it is left out. Other columns are
    not read.
    """
    return covered(docs, word_tokens, lambda texts, ids: least_ids(texts, ids, length), lambda t: t.count(b" ") + 1, _digest, DIGEST, length, max(1, min(GRAM, length - 1)))
