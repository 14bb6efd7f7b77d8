"""Packing: order-preserving dynamic programming over document and sentence boundaries.

The documents of a partition, in its order, are one stream of token ids. Windows of at most LENGTH
ids are cut from it where the sum of padding and truncation penalties is least: a cut costs nothing
between documents, a little after a sentence and more elsewhere. f(j) = pen(j) + LENGTH - pos(j) +
min(f(i) + pos(i)) over the boundaries i at most LENGTH before j; the minimum slides, so a monotone
queue finds it in constant time. What is left at a partition's end becomes sequences whose lengths
are powers of two, which need no padding.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerlark.llm.common import IS_WORD, flat, release, sorted_set, word_bounds

LENGTH, END_ID = 2048, 1
SENTENCE, ELSEWHERE = 2.0, 24.0
#: Ids after which a cut is allowed even inside a sentence; below LENGTH, so that a window always fits.
STRIDE = 256
#: Padding of the last window that is taken rather than a split into powers of two.
SPARE = 16
CHUNK, CACHE = 1 << 20, 600_000
PIECES = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
DDL = ", ".join(f"{f.name} long" for f in PIECES)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Texts in which white space, case, points, digits and other scripts stand beside each other.
PROBES = ["The cat,  sat. On THE mat!\nNew\tline; a.b,c x:y", " don't 3.5 (foo-bar) É1é... 'q'? 中文。字 \u00a0z", "AbC123 e.g. U.S.A., 10,000 -- __x__ #tag @me http://a.b/c?d=e", "naïve Straße à la río ΑΒΓ ñandú \U0001f600 ok", "x% y$$$ z& é*** ñ' É~ a\"b a=b a[b] {c} d^e f\\g h|i j`k l>m n<o p+q 'r's"]
#: A text with this may hold a special token, which is matched before any other step.
MARK = b"<|"
SPLITTER = "<|startoftext|>"
#: Runs of letters a-z, ß-ö and ø-ÿ alone, which are one word each, lower case and in normal form.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Their bytes that a byte-level model does not write as themselves.
MAPPED = (("\x9f", "\u0141"), ("\xa0", "\u0142"), ("\xad", "\u0143"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER, _SECOND, _POINT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
#: What follows 0xC3 in the letters À to ÿ: all but × and ÷.
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_POINT[list(string.punctuation.encode())] = True


def types(letters: bytes, size: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different contents of runs that stand one after the other, in the order of their first places, and for each run the number of its content."""
    stop = np.cumsum(size)
    bounds = np.concatenate([[0], stop])
    code = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode().indices.to_numpy().astype(np.int64)
    # contents are numbered as they come: each new one is over all before
    new = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))
    return [letters[a:b] for a, b in zip(bounds[new].tolist(), stop[new].tolist(), strict=True)], code


class Encoder:
    """Ids of texts.

    This tokenizer lower-cases, drops white space and merges neither across it nor between a letter
    and ASCII punctuation after it. So each run of other characters is encoded once, without the case
    of A-Z and apart from what stands after a letter from such a sign on, and its ids are kept for the
    next time. A tokenizer that gives other ids for PROBES in this way encodes whole texts.

    Runs of LETTERS go to the same model without the steps that find words and normal forms: blanks
    divide them, and an id that ends a word ends each.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.splitter = self.tokenizer.token_to_id(SPLITTER)
        self.letters, self.last = self.of_letters(path)
        self.in_runs = True
        if not self.same() and self.letters is not None:
            self.letters = None
            self.same()

    def of_letters(self, path: str):
        """A tokenizer for LETTERS and whether an id ends a word; None where the model does not mark that."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None, np.zeros(0, bool)
        one = Tokenizer.from_file(path)
        one.normalizer, one.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.CharDelimiterSplit(" ")
        known = one.get_vocab(with_added_tokens=True)
        last = np.zeros(max(known.values()) + 1, bool)
        last[[i for token, i in known.items() if token.endswith(suffix)]] = True
        return one, last

    def same(self) -> bool:
        """Whether PROBES have the tokenizer's ids; in_runs is set to it."""
        self.clear()
        self.in_runs = True
        ids, bounds, _ = self(pa.array(PROBES))
        self.in_runs = all(ids[a : b - 1].tolist() == self.tokenizer.encode(x, add_special_tokens=False).ids for x, a, b in zip(PROBES, bounds, bounds[1:], strict=False))
        self.clear()
        return self.in_runs

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def encode(self, runs: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all runs, one after the other, and each run's number of ids."""
        easy = np.fromiter(map(LETTERS.fullmatch, runs), bool, len(runs))
        if self.letters is None or not self.in_runs or not easy.any():
            return self.encode_any([x.decode("utf-8", "replace") for x in runs], plain)
        text = b" ".join(itertools.compress(runs, easy)).decode("latin-1")
        for byte, letter in MAPPED:
            text = text.replace(byte, letter)
        ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        stop = np.flatnonzero(self.last[ids]) + 1
        if len(stop) != easy.sum():
            return self.encode_any([x.decode("utf-8", "replace") for x in runs], plain)
        sizes = np.zeros(len(runs), np.int64)
        sizes[easy] = np.diff(stop, prepend=0)
        if easy.all():
            return ids, sizes
        others, sizes[~easy] = self.encode_any([x.decode("utf-8", "replace") for x in itertools.compress(runs, ~easy)], plain)
        of_easy = np.repeat(easy, sizes)
        out = np.empty(len(of_easy), np.uint32)
        out[of_easy], out[~of_easy] = ids, others
        return out, sizes

    def encode_any(self, fresh: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        if plain and self.splitter is not None:
            # special tokens divide a text before anything else happens to it
            ids = np.array(self.tokenizer.encode_batch_fast([SPLITTER.join(fresh)], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(ids == self.splitter)
            if len(at) == len(fresh) - 1:
                return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
        got = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        return np.fromiter((i for ids in got for i in ids), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids with END_ID after each row, each row's bounds, and the places where a sentence or line ends."""
        if len(self.known) > CACHE:
            self.clear()
        buf, at = flat(column)
        plain = MARK not in buf.tobytes()
        if plain and self.in_runs:
            buf = _LOWER[buf]
        starts, ends, first = word_bounds(buf, at)
        if not self.in_runs:
            starts, ends = at[:-1][np.diff(at) > 0], at[1:][np.diff(at) > 0]
            first = np.searchsorted(starts, at)
        elif plain and len(buf):
            letter = _LETTER[buf]
            letter[1:] |= (buf[:-1] == 0xC3) & _SECOND[buf[1:]]
            cut = np.flatnonzero(letter[:-1] & _POINT[buf[1:]]) + 1
            starts, ends = sorted_set(starts, cut), sorted_set(ends, cut)
            first = np.searchsorted(starts, at)
        runs, code = types((buf[IS_WORD[buf]] if self.in_runs else buf).tobytes(), ends - starts)
        known, before = self.known, len(self.known)
        number = np.fromiter(map(known.get, runs, itertools.repeat(-1)), np.int64, len(runs))
        fresh = list(itertools.compress(runs, number < 0))
        number[number < 0] = np.arange(before, before + len(fresh))
        code = number[code]
        if fresh:
            known.update(zip(fresh, range(before, before + len(fresh)), strict=True))
            ids, sizes = self.encode(fresh, plain)
            self.parts.append(ids)
            self.sizes.append(sizes)
            if len(self.parts) > 1:
                self.sizes, self.parts = [np.concatenate(self.sizes)], [np.concatenate(self.parts)]
        sizes = self.sizes[0] if self.sizes else np.zeros(0, np.int64)
        ids = self.parts[0] if self.parts else np.zeros(0, np.uint32)
        from_ = np.cumsum(sizes) - sizes
        own = sizes[code]
        stop = np.cumsum(own)
        before = np.concatenate([[0], stop])[first]  # ids before each row without end ids
        bounds = before + np.arange(len(at))
        out = np.full(int(bounds[-1]), END_ID, np.uint32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = ids[np.repeat(from_[code] - stop + own, own) + np.arange(int(before[-1]))]
        last = buf[ends - 1]
        sentence = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
        sentence |= np.append(buf, np.uint8(0))[ends] == 0x0A
        return out, bounds, (stop + np.repeat(np.arange(len(at) - 1), np.diff(first)))[sentence]


def cuts(bounds: np.ndarray, sentences: np.ndarray, final: bool) -> np.ndarray:
    """Where windows end, in a stream of documents that begins with a window. Unless final, what
    follows the last cut has no whole window's length yet."""
    n = int(bounds[-1])
    edge = sorted_set(bounds, sentences)
    gap = np.diff(edge)
    wide = np.flatnonzero(gap > STRIDE)
    more = [np.arange(edge[i] + STRIDE, edge[i + 1], STRIDE) for i in wide.tolist()]
    place = sorted_set(edge, *more)
    penalty = np.full(len(place), ELSEWHERE)
    penalty[np.searchsorted(place, sentences)] = SENTENCE
    penalty[np.searchsorted(place, bounds)] = 0.0
    pos, pen = place.tolist(), penalty.tolist()
    cost, back = [0.0] * len(pos), [0] * len(pos)  # cost: f(j) + pos(j)
    queue: deque[int] = deque([0])
    for j in range(1, len(pos)):
        p = pos[j]
        while pos[queue[0]] < p - LENGTH:
            queue.popleft()
        i = queue[0]
        back[j] = i
        c = pen[j] + LENGTH + cost[i]  # the padding's -pos(j) and cost's +pos(j) cancel
        cost[j] = c
        while queue and cost[queue[-1]] >= c:
            queue.pop()
        queue.append(j)
    out, j = [], len(pos) - 1
    if not final:
        # the end is open: begin at the best boundary in the last window's reach
        j = min((i for i in range(len(pos)) if pos[i] > n - LENGTH), key=lambda i: cost[i] + (ELSEWHERE if pos[i] == n else 0), default=j)
    while j > 0:
        out.append(pos[j])
        j = back[j]
    ends = out[::-1]
    if final and ends:
        begin = ends[-2] if len(ends) > 1 else 0
        left = ends[-1] - begin
        if left < LENGTH - SPARE and left & (left - 1):
            ends.pop()
            for bit in range(11, -1, -1):
                if left >> bit & 1:
                    begin += 1 << bit
                    ends.append(begin)
    return np.array(ends, np.int64)


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of a document in a sequence of at most LENGTH ids.

    A null or empty text is its end id alone. Documents keep their partition's order; each partition
    packs by itself, in parts of about a MB, and carries an open window from part to part, so memory
    does not grow and nothing is shuffled. Rows that repeat an id are packed each; a very long text is
    cut into as many windows as it fills. Other columns are not read. An empty table gives no pieces.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        encoder = None
        sequence = TaskContext.get().partitionId() << 40
        # the open window: its documents' ids, starts, totals and tokens
        held_id, held_start, held_total, held = [], [], [], []

        def emit(ids, bounds, ends, doc_id, start, total) -> pa.RecordBatch:
            nonlocal sequence
            stop = int(ends[-1]) if len(ends) else 0
            edge = sorted_set([0], bounds[bounds <= stop], ends)
            a, b = edge[:-1], edge[1:]
            which = np.searchsorted(bounds, a, "right") - 1
            window = np.searchsorted(ends, a, "right")
            begin = np.concatenate([[0], ends])[window]
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            out = [pa.array([doc_id[i] for i in which.tolist()], pa.int64()), start[which] + a - bounds[which], b - a, crc, total[which], window + sequence, a - begin]
            sequence += len(ends)
            return pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in out], schema=PIECES)

        def parts():
            for batch in batches:
                if batch.num_rows:
                    size = np.cumsum(np.diff(flat(batch["text"])[1]))
                    at = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), batch.num_rows]
                    for a, b in zip(at, at[1:], strict=False):
                        yield batch.slice(a, b - a)
            yield None

        for part in parts():
            encoder = encoder or Encoder(path)
            doc_id, ids, bounds, sentences = [], np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)
            if part is not None:
                doc_id = part["doc_id"].to_pylist()
                ids, bounds, sentences = encoder(part["text"])
            old = np.concatenate([[0], np.cumsum([len(x[0]) for x in held])]).astype(np.int64)
            total = np.concatenate([np.array(held_total, np.int64), np.diff(bounds)])
            start = np.concatenate([np.array(held_start, np.int64), np.zeros(len(doc_id), np.int64)])
            sentences = np.concatenate([*(x[1] + o for x, o in zip(held, old.tolist(), strict=False)), sentences + old[-1]]).astype(np.int64)
            ids = np.concatenate([*(x[0] for x in held), ids])
            doc_id, bounds = held_id + doc_id, np.concatenate([old, bounds[1:] + old[-1]])
            if not len(doc_id):
                continue
            ends = cuts(bounds, sentences, part is None)
            if len(ends):
                yield emit(ids, bounds, ends, doc_id, start, total)
            stop = int(ends[-1]) if len(ends) else 0
            rest = range(int(np.searchsorted(bounds, stop, "right")) - 1, len(doc_id))
            held_id, held_start, held_total, held = [], [], [], []
            for i in rest:
                a, b = max(stop, int(bounds[i])), int(bounds[i + 1])
                if b > a:
                    held_id.append(doc_id[i])
                    held_start.append(int(start[i]) + a - int(bounds[i]))
                    held_total.append(int(total[i]))
                    held.append((ids[a:b], sentences[(sentences > a) & (sentences <= b)] - a))

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, DDL)
