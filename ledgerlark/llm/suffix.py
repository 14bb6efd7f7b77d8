"""Suffix-array dedup: induced sorting of a shard's texts and permuted common prefixes, whose lengths
tell which suffixes share a window.

The sort classifies suffixes as S or L, sorts the leftmost-S (LMS) substrings by inducing from
them, names them, sorts the reduced string recursively and induces the whole array from the sorted
LMS suffixes; each step is linear, and works on whole arrays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlark.llm.windows import NO_ID, byte_tokens, covered, ids_of

LENGTH = 50
GRAM = 16
#: Places that are looked up at once: numpy widens an index and its temporaries are of 64 bits.
BLOCK = 1 << 18


def _at(x: np.ndarray, index: np.ndarray) -> np.ndarray:
    """x[index], block by block."""
    out = np.empty(len(index), x.dtype)
    for a in range(0, len(index), BLOCK):
        out[a : a + BLOCK] = x[index[a : a + BLOCK]]
    return out


def _put(x: np.ndarray, index: np.ndarray, values: np.ndarray) -> None:
    """x[index] = values, block by block."""
    for a in range(0, len(index), BLOCK):
        x[index[a : a + BLOCK]] = values[a : a + BLOCK]


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last symbol is the smallest and occurs once."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])  # i: s[i] != s[i + 1]
    is_s = np.ones(n, bool)
    if len(differs):  # each run of one symbol has the type of its last place
        is_s[:-1] = np.repeat(s[differs] < s[differs + 1], np.diff(differs, prepend=-1))
    return is_s


def _lms(is_s: np.ndarray) -> np.ndarray:
    return (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)


def _scatter(sa: np.ndarray, free: np.ndarray, chars: np.ndarray, where: np.ndarray, step: int) -> None:
    """Put each place at the next free slot of its symbol's bucket, in order; step is 1 from a bucket's head, -1 from its tail."""
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    new = chars[1:] != chars[:-1]
    if new.all():
        slot = free[chars]
        sa[slot] = where[order]
        free[chars] = slot + step
        return
    at = np.concatenate([[0], np.flatnonzero(new) + 1])
    size = np.diff(np.append(at, len(chars)))
    rank = np.arange(len(chars)) - np.repeat(at, size)
    sa[free[chars] + step * rank] = where[order]
    free[chars[at]] += step * size


def _induce(s: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """All suffixes, in the order that the LMS suffixes in `seeds` induce.

    Buckets are taken in order, as many at a time as give nothing to each other; what they give to
    later ones is one stable split. A bucket that gives to itself goes alone, in rounds.
    """
    n = len(s)
    start = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=k))])
    middle = start[:-1] + np.bincount(s[~is_s], minlength=k)  # where a bucket's S suffixes begin
    sa = np.full(n, -1, np.int32)
    tails = start[1:] - 1
    _scatter(sa, tails, s[seeds[::-1]], seeds[::-1], -1)
    # the symbol before each place if its suffix has the type in turn, else k; also for place -1, an empty slot
    before = np.full(n + 1, k, s.dtype)

    def given(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the entries induce: their index in part, the suffixes and their symbols."""
        chars = before[part]
        at = np.flatnonzero(chars < k)
        return at, part[at] - 1, chars[at]

    before[1:n] = np.where(is_s[:-1], k, s[:-1])
    heads = start[:-1].copy()
    c, many = 0, 1 << 12
    while c < k:
        top = max(c + 1, int(np.searchsorted(start, start[c] + many, "right")) - 1)
        at, where, chars = given(sa[start[c] : start[top]]) if top > c + 1 else (None, None, None)
        own = c if at is None else int(chars.min()) if len(chars) else k
        if own >= top:
            if len(where):
                _scatter(sa, heads, chars, where, 1)
            c, many = top, min(many * 2, 1 << 16)
        elif own > c:
            use = int(np.searchsorted(at, start[own] - start[c]))
            if use:
                _scatter(sa, heads, chars[:use], where[:use], 1)
            many = max(64, start[own] - start[c])
            c = own
        else:
            done = start[c]
            while done < heads[c]:
                stop = heads[c]
                _, where, chars = given(sa[done:stop])
                if len(where):
                    _scatter(sa, heads, chars, where, 1)
                done = stop
            _, where, chars = given(sa[middle[c] : start[c + 1]])
            if len(where):
                _scatter(sa, heads, chars, where, 1)
            c += 1
    for_s = np.repeat(np.stack([np.zeros(k, bool), np.ones(k, bool)], 1).ravel(), np.stack([middle - start[:-1], start[1:] - middle], 1).ravel())
    sa[for_s] = -1
    before[1:n] = np.where(is_s[:-1], s[:-1], k)
    tails = start[1:] - 1
    sa[0], tails[0] = n - 1, tails[0] - 1  # the last suffix; no other induces it
    c, many = k, 1 << 12
    while c > 0:
        low = min(c - 1, int(np.searchsorted(start, start[c] - many, "left")))
        at, where, chars = given(sa[start[low] : start[c]][::-1]) if low < c - 1 else (None, None, None)
        own = c - 1 if at is None else int(chars.max()) if len(chars) else -1
        if own < low:
            if len(where):
                _scatter(sa, tails, chars, where, -1)
            c, many = low, min(many * 2, 1 << 16)
        elif own < c - 1:
            use = int(np.searchsorted(at, start[c] - start[own + 1]))
            if use:
                _scatter(sa, tails, chars[:use], where[:use], -1)
            many = max(64, start[c] - start[own + 1])
            c = own + 1
        else:
            done = start[c] - 1
            while done > tails[c - 1]:
                stop = tails[c - 1]
                _, where, chars = given(sa[stop + 1 : done + 1][::-1])
                if len(where):
                    _scatter(sa, tails, chars, where, -1)
                done = stop
            _, where, chars = given(sa[start[c - 1] : middle[c - 1]][::-1])
            if len(where):
                _scatter(sa, tails, chars, where, -1)
            c -= 1
    return sa


def _names(s: np.ndarray, is_s: np.ndarray, order: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each LMS substring, in text order; equal substrings share one."""
    end = np.full(len(s), 0, np.int32)
    end[lms[:-1]] = lms[1:]
    end[lms[-1]] = lms[-1]
    size = _at(end, order) - order + 1
    del end
    same = np.zeros(len(order), bool)
    pairs = np.flatnonzero(size[1:] == size[:-1]) + 1
    part = np.cumsum(size[pairs], dtype=np.int64) // BLOCK
    for x in np.split(pairs, np.flatnonzero(np.diff(part)) + 1) if len(pairs) else ():
        n = size[x].astype(np.int64)
        begin = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(begin, n)
        equal = s[np.repeat(order[x], n) + step] == s[np.repeat(order[x - 1], n) + step]
        same[x] = np.logical_and.reduceat(equal, begin)
    rank = np.cumsum(~same, dtype=np.int32) - 1
    name = np.empty(len(s), np.int32)
    _put(name, order, rank)
    return _at(name, lms), int(rank[-1]) + 1


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of s, symbols below k, which ends with its only 0."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    is_s = _types(s)
    lms = _lms(is_s)
    first = _induce(s, is_s, lms, k)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    first = first[_at(is_lms, first)]
    del is_lms
    names, count = _names(s, is_s, first, lms)
    del first
    if count < len(lms):
        order = lms[suffix_array(names, count)]
    else:
        order = lms[np.argsort(names)]
    return _induce(s, is_s, order, k)


def common_prefixes(text: np.ndarray, sa: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Permuted common prefixes: for each of `places`, in text order, how many bytes it has in common with
    the suffix before it in the array, up to `length`. Only those of `places` count as such suffixes."""
    phi = np.full(len(text), -1, np.int32)
    ordered = sa[_at(places, sa)]
    _put(phi, ordered[1:], ordered[:-1])
    del ordered
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray((len(text) + 1,), np.uint64, padded, strides=(1,))  # the eight bytes from each place on, the first lowest
    out = np.zeros(len(text), np.uint8 if length < 256 else np.int32)
    for a in range(0, len(text), BLOCK):
        place = np.flatnonzero(phi[a : a + BLOCK] >= 0) + a
        before = phi[place].astype(np.int64)
        for step in range(0, length, 8):
            x = words[place + step] ^ words[before + step]
            same = x == 0
            other = np.flatnonzero(~same)
            x = x[other]
            out[place[other]] = np.minimum(step + (np.bitwise_count((x & -x) - np.uint64(1)) >> 3), length)
            place, before = place[same], before[same]
        out[place] = length
    return out


def least_ids(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each text, the least id over all texts that hold it; and each text's number of windows."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    s = text.astype(np.uint16) + np.uint16(2)
    s[begin + size] = 1  # between texts; no byte is 1
    s[-1] = 0
    # symbols that occur, in their order
    have = np.zeros(258, bool)
    have[s] = True
    s = (np.cumsum(have) - 1).astype(np.uint16)[s]
    sa = suffix_array(s, int(have.sum()))
    count = size - length + 1
    owner = np.full(len(s), -1, np.int32)
    place = (np.repeat((begin - (np.cumsum(count) - count)).astype(np.int32), count) + np.arange(count.sum(), dtype=np.int32)).astype(np.int32)
    owner[place] = np.repeat(np.arange(len(texts), dtype=np.int32), count)
    prefix = common_prefixes(text, sa, owner >= 0, length)
    sa = sa[_at(owner, sa) >= 0]
    new = _at(prefix, sa) < length
    new[0] = True
    at = np.flatnonzero(new)
    del prefix, new
    # ids by their ranks, which are half as wide
    distinct, rank = np.unique(ids, return_inverse=True)
    best = np.minimum.reduceat(_at(rank.astype(np.int32), _at(owner, sa)), at)
    del owner
    out = np.empty(len(s), np.int32)
    _put(out, sa, np.repeat(best, np.diff(np.append(at, len(sa)))))
    del sa, at, best
    return _at(distinct, _at(out, place)), count


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(table: pa.Table, t, removed: np.ndarray) -> pa.Table:
    first, text = t.first, t.text
    edge = np.diff(np.concatenate([[0], removed.astype(np.int8)])) == 1
    at = first[:-1][(first[:-1] < first[1:])]
    edge[at] = removed[at]  # a run does not go on from one document to the next
    total, spans = np.concatenate([[0], np.cumsum(removed)]), np.concatenate([[0], np.cumsum(edge)])
    kept = text[~removed].tobytes()
    place = (first - total[first]).tolist()
    return pa.table({
        "doc_id": table["doc_id"], "n_bytes": np.diff(first), "n_removed": np.diff(total[first]), "n_spans": np.diff(spans[first]),
        "kept_sha256": [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(place, place[1:], strict=False)],
    }, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))


def dedup_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: bytes, bytes that a `length`-byte string of a smaller doc_id covers, their runs, and what is left as a digest.

    A null text is empty; an empty or short text keeps all its bytes. A null doc_id counts as larger
    than any other. Rows that repeat an id never remove from each other. A very long text is in one
    bucket, cut into pieces like any other; no window of it is left out. Other columns are not read.
    """
    return covered(docs, byte_tokens, lambda texts, ids: least_ids(texts, ids, length), len, _digest, DIGEST, length, min(GRAM, length - 1))


def dedup_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs (doc_id, text, lang, source, n_chars) with the covered bytes removed from text.

    A character of which any byte is covered goes whole, so what is left is UTF-8 as before. Rows
    stay, with null texts as they are; n_chars is counted anew where text is not null.
    """
    columns = ("lang", "source", "n_chars")

    def cut(table: pa.Table, t, removed: np.ndarray) -> pa.Table:
        head = np.flatnonzero((t.text & 0xC0) != 0x80)  # a character's first byte
        if len(head):
            whole = np.logical_or.reduceat(removed, head)
            removed = np.repeat(whole, np.diff(np.append(head, len(removed))))
        kept = t.text[~removed].tobytes()
        at = (t.first - np.concatenate([[0], np.cumsum(removed)])[t.first]).tolist()
        texts = [None if x is None else kept[a:b].decode("utf-8", "replace") for x, a, b in zip(table["text"].to_pylist(), at, at[1:], strict=False)]
        return pa.table({
            "doc_id": table["doc_id"], "text": pa.array(texts, pa.string()), "lang": table["lang"].cast(pa.string()), "source": table["source"].cast(pa.string()),
            "n_chars": pa.array([n if x is None else len(x) for n, x in zip(table["n_chars"].to_pylist(), texts, strict=True)], pa.int64()),
        })

    return covered(docs, byte_tokens, lambda texts, ids: least_ids(texts, ids, length), len, cut, "doc_id long, text string, lang string, source string, n_chars long", length, min(GRAM, length - 1), columns)
