"""Which windows of L consecutive tokens also start in a document with a smaller id.

Shared by the two operators that remove repeated passages. They differ in the tokens (words or
bytes) and in the index that decides inside a shard; this module brings equal windows together:

1. Documents are dealt to buckets of a few MB by a hash of id and text. Each window of L tokens is
   labelled by its minimiser, the least hash among its k-grams. Consecutive windows with one label
   form a piece, so a text splits into few pieces and equal windows always carry equal labels.
2. Each bucket sends its distinct labels, packed, to the labels' owners, which send back those that
   two documents have. A passage that a third of all documents share is one label per bucket.
3. Pieces with such a label go, distinct per bucket and with the least id that has them, to the
   label's shard, with three bytes of the label. A label of which a shard has one text only needs no
   index: its windows occur in that text alone. For all others the index (FM-index or suffix array)
   finds, for each window, the least document id over all pieces that hold the same tokens.
4. A bucket gets an answer for a piece only where that id is less than its own least id.

All tables are keyed by bucket, label range or shard, none of which is a document property, so no
hot source, passage or group of copies meets in one task as rows. Nothing is dropped: labels only
route, the index compares the tokens themselves. Everything is one lazy plan; the exchange of the
documents is planned once and read by each step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import flat, release, text_size, word_bounds

#: Ids compare as 64-bit integers; a missing id is larger than all others.
NO_ID = np.iinfo(np.int64).max
BUCKET_BYTES = 2 << 20
OWNER_BYTES = 8 << 20
SHARD_BYTES = 7 << 20
TILE = 1 << 16

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Tokens:
    """Tokens of a batch of texts. text holds them with `gap` separating bytes after each; begin(i) is a token's place there."""

    text: np.ndarray
    first: np.ndarray  # tokens before each row
    hashes: Callable[[int, int], np.ndarray]
    begin: Callable[[np.ndarray], np.ndarray]
    gap: int

    @property
    def n(self) -> int:
        return int(self.first[-1])


def byte_tokens(column) -> Tokens:
    buf, at = flat(column)
    return Tokens(buf, at, lambda a, b: _BYTE[buf[a:b]], lambda i: i, 0)


def word_tokens(column) -> Tokens:
    buf, at = flat(column)
    starts, ends, first = word_bounds(buf, at)
    size = ends - starts
    place = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.full(place[-1], 32, np.uint8)
    index = np.repeat(np.arange(len(size)), size)
    rel = np.arange(len(index)) - np.repeat(np.cumsum(size) - size, size)
    if len(index):
        letters = buf[rel + starts[index]]
        text[place[index] + rel] = letters
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()), _ODD[0])]).astype(np.uint64))
        hashes = mixed(np.add.reduceat(_BYTE[letters] * power[rel], np.cumsum(size) - size))
    else:
        hashes = np.zeros(0, np.uint64)
    return Tokens(text, first, lambda a, b: hashes[a:b], lambda i: place[i], 1)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k tokens in a row, by doubling."""
    out, have, done, base = None, 1, 0, h
    while True:
        if k & have:
            if out is None:
                out = base[done:] if done else base
            else:
                n = len(h) - done - have + 1
                out = out[: max(n, 0)] * _ODD[20 + have.bit_length()] + base[done : done + max(n, 0)]
            done += have
        have *= 2
        if have > k:
            break
        half = have // 2
        base = base[: max(len(base) - half, 0)] * _ODD[have.bit_length()] + base[half:]
    return mixed(out[: max(len(h) - k + 1, 0)])


def least(h: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have * 2 <= w:
        h = np.minimum(h[: max(len(h) - have, 0)], h[have:])
        have *= 2
    if have < w:
        h = np.minimum(h[: max(len(h) - (w - have), 0)], h[w - have :])
    return h


def pieces(t: Tokens, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window and number of windows, and label of every piece."""
    rows, starts, counts, labels = [], [], [], []
    for a in range(0, t.n - length + 1, TILE):
        b = min(a + TILE, t.n - length + 1)
        m = least(grams(t.hashes(a, b + length - 1), k), length - k + 1)
        lo, hi = np.searchsorted(t.first, [a, b])
        edges = np.concatenate([t.first[lo:hi], (t.first[lo:hi] - length + 1).clip(a), (t.first[hi : hi + 1] - length + 1).clip(a, b - 1)]) - a
        cut = np.zeros(b - a, bool)
        cut[1:] = m[1:] != m[:-1]
        cut[edges] = True
        cut[0] = True
        at = np.flatnonzero(cut)
        size = np.diff(np.append(at, b - a))
        row = np.searchsorted(t.first, at + a, "right") - 1
        fits = at + a + length <= t.first[row + 1]
        at = at[fits]
        rows.append(row[fits])
        starts.append(at + a)
        counts.append(size[fits])
        labels.append(m[at] | np.uint64(1))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else e for x, e in ((rows, empty), (starts, empty), (counts, empty), (labels, np.zeros(0, np.uint64))))  # type: ignore[return-value]


def ids_of(column) -> np.ndarray:
    return np.asarray(column.combine_chunks().cast(pa.int64()).fill_null(NO_ID) if isinstance(column, pa.ChunkedArray) else column.cast(pa.int64()).fill_null(NO_ID))


def _ranges(labels: np.ndarray, n: int) -> np.ndarray:
    """Which of n even ranges of the label space each label is in."""
    return ((labels >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _bucket(table: pa.Table, tokens) -> tuple[pa.Table, Tokens, np.ndarray]:
    """The bucket's documents in an order that every step finds again."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return table, tokens(table["text"]), ids_of(table["doc_id"])


def _chosen(t: Tokens, ids: np.ndarray, length: int, k: int, shared: np.ndarray):
    """Pieces with a shared label, and for each the number of its text among the bucket's distinct ones."""
    row, start, count, label = pieces(t, length, k)
    if len(shared):
        keep = shared[np.minimum(np.searchsorted(shared, label), len(shared) - 1)] == label
    else:
        keep = np.zeros(len(label), bool)
    row, start, count, label = row[keep], start[keep], count[keep], label[keep]
    a, b = t.begin(start), t.begin(start + count + length - 1) - t.gap
    data = t.text.tobytes()
    seen: dict[bytes, int] = {}
    which = np.fromiter((seen.setdefault(data[x:y], len(seen)) for x, y in zip(a.tolist(), b.tolist(), strict=True)), np.int64, len(a))
    lowest = np.full(len(seen), NO_ID, np.int64)
    np.minimum.at(lowest, which, ids[row])
    return row, start, count, label, which, list(seen), lowest


def covered(docs: DataFrame, tokens, solve, count_tokens, digest, digest_schema: str, length: int, k: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """digest(table, tokens, removed) for each bucket of docs; removed marks each token that a repeated window covers.

    solve(texts, ids) gets a shard's distinct pieces whose labels have several texts, and the least id
    of each, and returns for all their windows, one piece after the other, the least id over the
    pieces that have that window; count_tokens(text) is a piece's number of tokens.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    _, size = text_size(docs)
    n_buckets, owners, shards = size // BUCKET_BYTES + 12, size // OWNER_BYTES + 12, size // SHARD_BYTES + 12
    # rows that repeat an id are dealt by their texts: they remove nothing from each other, wherever they are
    dealt = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_buckets)))

    def label_sets(key, table):
        table, t, ids = _bucket(table, tokens)
        row, _, _, label = pieces(t, length, k)
        order = np.argsort(label, kind="stable")
        label, who = label[order], ids[row][order]
        at = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]])) if len(label) else np.zeros(0, np.int64)
        out = label[at]
        if len(at):
            several = np.minimum.reduceat(who, at) != np.maximum.reduceat(who, at)
            out = np.where(several, out, out ^ np.uint64(1))  # the last bit: two documents of the bucket have it
        owner = _ranges(out, owners)
        cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(out) else np.zeros(0, np.int64)
        return pa.table({"owner": owner[cuts].astype(np.int64), "bucket": np.full(len(cuts), key[0].as_py(), np.int64), "packed": pa.array([_packed(x) for x in np.split(out, cuts[1:])] if len(cuts) else [], pa.binary())})

    def shared_sets(key, table):
        parts = [np.frombuffer(x, np.uint64) for x in table["packed"].to_pylist()]
        every = np.concatenate(parts)
        order = np.argsort(every)
        label = every[order] | np.uint64(1)
        new = np.concatenate([[True], label[1:] != label[:-1]])
        group = np.cumsum(new) - 1
        common = (np.bincount(group) > 1) | np.logical_or.reduceat((every[order] & np.uint64(1)).astype(bool), np.flatnonzero(new))
        is_shared = np.empty(len(every), bool)
        is_shared[order] = common[group]
        out_bucket, out = [], []
        at = 0
        for bucket, x in zip(table["bucket"].to_pylist(), parts, strict=True):
            mine = x[is_shared[at : at + len(x)]] | np.uint64(1)
            at += len(x)
            if len(mine):
                out_bucket.append(bucket)
                out.append(_packed(mine))
        return pa.table({"bucket": pa.array(out_bucket, pa.int64()), "shared": pa.array(out, pa.binary()), "answer": pa.nulls(len(out), pa.binary())})

    def known(table: pa.Table) -> np.ndarray:
        return np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in table["shared"].to_pylist() if x is not None)]))

    def send_pieces(key, table, shared):
        labels = known(shared)
        if not table.num_rows or not len(labels):
            return pa.table({c: pa.array([], kind) for c, kind in piece_types})
        table, t, ids = _bucket(table, tokens)
        _, _, _, label, which, texts, lowest = _chosen(t, ids, length, k, labels)
        of = np.zeros(len(texts), np.uint64)
        of[which] = label
        shard = _ranges(mixed(of), shards).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        out = {c: [] for c, _ in piece_types}
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
            own = [texts[i] for i in part.tolist()]
            for c, v in (("shard", shard[part[0]]), ("bucket", key[0].as_py()), ("number", _packed(part.astype(np.int32))), ("lowest", _packed(lowest[part])), ("size", _packed(np.fromiter(map(len, own), np.int32, len(own)))), ("mark", _packed(of[part].view(np.uint8).reshape(-1, 8)[:, 1:4])), ("texts", pa.compress(b"".join(own), "zstd", asbytes=True))):
                out[c].append(v)
        return pa.table({c: pa.array(out[c], kind) for c, kind in piece_types})

    piece_types = (("shard", pa.int64()), ("bucket", pa.int64()), ("number", pa.binary()), ("lowest", pa.binary()), ("size", pa.binary()), ("mark", pa.binary()), ("texts", pa.binary()))

    def solve_shard(key, table):
        seen: dict[bytes, int] = {}
        which, lowest = [], [np.frombuffer(x, np.int64) for x in table["lowest"].to_pylist()]
        marks = np.frombuffer(b"".join(table["mark"].to_pylist()), np.uint8).reshape(-1, 3).astype(np.int64) @ np.array([1, 1 << 8, 1 << 16])
        for size, data in zip(table["size"].to_pylist(), table["texts"].to_pylist(), strict=True):
            end = np.cumsum(np.frombuffer(size, np.int32), dtype=np.int64)
            data = pa.decompress(data, int(end[-1]), "zstd", asbytes=True)
            which.append(np.fromiter((seen.setdefault(data[x:y], len(seen)) for x, y in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)), np.int64, len(end)))
        best = np.full(len(seen), NO_ID, np.int64)
        np.minimum.at(best, np.concatenate(which), np.concatenate(lowest))
        texts = list(seen)
        del seen
        mark = np.empty(len(texts), np.int64)
        mark[np.concatenate(which)] = marks
        _, group, size = np.unique(mark, return_inverse=True, return_counts=True)
        several = size[group] > 1
        count = np.fromiter(map(count_tokens, texts), np.int64, len(texts)) - length + 1
        result = np.repeat(best, count)
        if several.any():
            at = np.flatnonzero(several)
            found, _ = solve([texts[i] for i in at.tolist()], best[at])
            result[np.repeat(several, count)] = found
        del texts
        release()
        # runs of equal ids within each piece
        stop = np.cumsum(count)
        new = np.concatenate([[True], result[1:] != result[:-1]])
        new[stop[:-1]] = True
        at = np.flatnonzero(new)
        run_size, run_id = np.diff(np.append(at, len(result))), result[at]
        run_first = np.searchsorted(at, stop - count)
        run_last = np.append(run_first[1:], len(at))
        smallest = np.minimum.reduceat(result, stop - count)
        buckets, answers = [], []
        for bucket, number, own, mine in zip(table["bucket"].to_pylist(), table["number"].to_pylist(), lowest, which, strict=True):
            tell = np.flatnonzero(smallest[mine] < own)
            if not len(tell):
                continue
            piece = mine[tell]
            runs = run_last[piece] - run_first[piece]
            pick = np.repeat(run_first[piece] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
            buckets.append(bucket)
            answers.append(b"".join((np.array([len(tell), len(pick)], np.int64).tobytes(), _packed(run_id[pick]), _packed(np.frombuffer(number, np.int32)[tell]), _packed(runs.astype(np.int32)), _packed(run_size[pick].astype(np.int32)))))
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "shared": pa.nulls(len(buckets), pa.binary()), "answer": pa.array(answers, pa.binary())})

    def apply_answers(key, table, told):
        table, t, ids = _bucket(table, tokens)
        removed = np.zeros(t.n + 1, np.int32)
        labels = known(told)
        if len(labels):
            row, start, count, _, which, texts, lowest = _chosen(t, ids, length, k, labels)
            values, sizes = lowest.copy(), np.ones(len(texts), np.int64)  # runs of each text; one run, unless told
            more: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for x in told["answer"].to_pylist():
                if x is None:
                    continue
                n, m = np.frombuffer(x, np.int64, 2)
                run_id = np.frombuffer(x, np.int64, m, 16)
                number, runs, run_size = np.split(np.frombuffer(x, np.int32, n + n + m, 16 + 8 * m), [n, 2 * n])
                begin = np.cumsum(runs) - runs
                one = runs == 1
                values[number[one]] = run_id[begin[one]]
                for i in np.flatnonzero(~one).tolist():
                    more[int(number[i])] = (run_id[begin[i] : begin[i] + runs[i]], run_size[begin[i] : begin[i] + runs[i]])
                    sizes[number[i]] = 0
            whole = sizes[which] == 1
            hit = whole & (values[which] < ids[row])
            np.add.at(removed, start[hit], 1)
            np.add.at(removed, start[hit] + count[hit] + length - 1, -1)
            for i in np.flatnonzero(~whole).tolist():
                run_id, run_size = more[int(which[i])]
                stop = np.cumsum(run_size)
                for a, b in zip(stop[run_id < ids[row[i]]] - run_size[run_id < ids[row[i]]], stop[run_id < ids[row[i]]], strict=True):
                    removed[start[i] + a] += 1
                    removed[start[i] + b + length - 1] -= 1
        out = digest(table, t, np.cumsum(removed[:-1]) > 0)
        release()
        return out

    by = dealt.groupBy("bucket")
    packed = by.applyInArrow(label_sets, "owner long, bucket long, packed binary")
    shared = packed.groupBy("owner").applyInArrow(shared_sets, "bucket long, shared binary, answer binary")
    sent = by.cogroup(shared.groupBy("bucket")).applyInArrow(send_pieces, "shard long, bucket long, number binary, lowest binary, size binary, mark binary, texts binary")
    answers = sent.groupBy("shard").applyInArrow(solve_shard, "bucket long, shared binary, answer binary")
    return by.cogroup(shared.unionAll(answers).groupBy("bucket")).applyInArrow(apply_answers, digest_schema)
