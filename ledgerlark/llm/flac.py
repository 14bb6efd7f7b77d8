"""Media columns: FLAC streams written and read back, many frames side by side.

Frames are lanes: the encoder makes a block of samples a matrix row, the decoder takes one Rice code
of every frame per step, so both run on whole arrays. Streams are mono, 8 bits, 1024 samples a
frame, with fixed or fitted (LPC) linear predictors and one Rice partition, or verbatim where that is
shorter, a STREAMINFO block with MD5 and a seek point for every frame. The reader also takes constant
subframes, several partitions and escaped ones; it checks CRC-8, CRC-16 and MD5 and raises on damage.
What is read back becomes PCM blocks, each with the sample it begins at, and bytes are read from those.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlark.llm.common import flat

BLOCK, RATE, PAD = 1024, 8000, 64
#: Order and coefficients' bits of fitted predictors, and how much smaller their residuals must be to be taken.
ORDER, PRECISION, GAIN = 4, 12, 0.98
#: Seek points that a table's length can count; a longer stream has no table and is read frame by frame.
POINTS = ((1 << 24) - 1) // 18
CHUNK = 4 << 20


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = []
    for x in range(256):
        x <<= bits - 8
        for _ in range(8):
            x = ((x << 1) ^ (poly if x >> (bits - 1) else 0)) & ((1 << bits) - 1)
        out.append(x)
    return np.array(out, np.uint16)


#: The polynomials of FLAC's header and frame checksums.
CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    x = 0
    for b in data:
        x = int(CRC8[x ^ b])
    return x


def crc16(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of buf[start : start + size] for every lane."""
    order = np.argsort(-size, kind="stable")
    begin, crc, left = start[order], np.zeros(len(start), np.uint16), size[order]
    live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0))  # lanes longer than i
    for i, n in enumerate(live.tolist()):
        c = crc[:n]
        crc[:n] = (c << np.uint16(8)) ^ CRC16[(c >> np.uint16(8)) ^ buf[begin[:n] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _coded_number(n: int) -> bytes:
    if n < 0x80:
        return bytes([n])
    tail = []
    limit = 0x40
    while n >= limit:
        tail.append(0x80 | (n & 0x3F))
        n >>= 6
        limit >>= 1
    return bytes([(0xFF ^ (limit * 2 - 1)) & 0xFF | n, *reversed(tail)])


@lru_cache(1 << 16)
def _frame_header(number: int, size: int) -> bytes:
    code = 10 if size == BLOCK else 7
    head = bytes([0xFF, 0xF8, code << 4 | 4, 0b0000_001_0]) + _coded_number(number) + (b"" if size == BLOCK else (size - 1).to_bytes(2, "big"))
    return head + bytes([crc8(head)])


def _put(out: np.ndarray, end: np.ndarray, value: np.ndarray) -> None:
    """Add values of up to 16 bits whose last bit is just before bit `end`; a code is one bincount per byte it can touch."""
    last = end - 1
    wide = value << (7 - (last & 7))
    at = (last >> 3) + 2
    for k in range(3):
        part = (wide >> (8 * k)) & 0xFF
        have = np.flatnonzero(part) if k else slice(None)
        out += np.bincount(at[have] - k, part[have], len(out)).astype(np.uint8)


def _fitted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole coefficients, shift and residuals of a predictor of each row, by Levinson and Durbin's recursion on its autocorrelation."""
    n = x.shape[1]
    wide = x.astype(np.int64)
    r = np.stack([(wide[:, k:] * wide[:, : n - k]).sum(axis=1) for k in range(ORDER + 1)], axis=1).astype(float)
    a, error = np.zeros((len(x), ORDER)), np.maximum(r[:, 0], 1.0)
    for i in range(ORDER):
        k = r[:, i + 1].copy()
        for j in range(i):
            k -= a[:, j] * r[:, i - j]
        k = np.clip(k / error, -0.999, 0.999)
        before = a[:, :i].copy()
        a[:, i] = k
        a[:, :i] = before - k[:, None] * before[:, ::-1]
        error = np.maximum(error * (1 - k * k), 1e-6)
    top = (1 << (PRECISION - 1)) - 1
    _, exponent = np.frexp(top / np.maximum(np.abs(a).max(axis=1), 1e-6))
    shift = np.clip(exponent - 1, 0, 15).astype(np.int64)
    coefs = np.clip(np.rint(a * (1 << shift)[:, None]), -top, top).astype(np.int64)
    guess = np.zeros((len(x), n - ORDER), np.int64)
    for j in range(ORDER):
        guess += coefs[:, j : j + 1] * wide[:, ORDER - 1 - j : n - 1 - j]
    return coefs, shift, (wide[:, ORDER:] - (guess >> shift[:, None])).astype(np.int32)


def encode(payloads: list[np.ndarray]) -> list[bytes]:
    """A FLAC stream of each payload, uint8 arrays of at least 16 bytes."""
    sizes = np.array([len(p) for p in payloads])
    frames = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(payloads)), frames)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(frames) - frames, frames)
    begin = np.repeat(np.cumsum(sizes) - sizes, frames) + number * BLOCK
    size = np.minimum(BLOCK, np.repeat(sizes, frames) - number * BLOCK)
    samples = np.concatenate(payloads).astype(np.int32) - 128
    heads = [_frame_header(a, b) for a, b in zip(number.tolist(), size.tolist(), strict=True)]
    head_size = np.fromiter(map(len, heads), np.int64, len(heads))
    body_bits = np.empty(len(doc), np.int64)
    plans = []
    for n in np.unique(size).tolist():
        lane = np.flatnonzero(size == n)
        x = samples[begin[lane][:, None] + np.arange(n)]
        first = np.diff(x, axis=1)
        second = np.diff(first, axis=1)
        coefs, shift, fitted = _fitted(x)
        cost = np.stack([np.abs(r).mean(axis=1) for r in (x, first, second)])
        order = np.argmin(cost, axis=0)
        lpc = np.abs(fitted).mean(axis=1) < GAIN * cost.min(axis=0)
        u = x.copy()
        u[order == 1, 1:] = first[order == 1]
        u[order == 2, 2:] = second[order == 2]
        u[lpc, ORDER:] = fitted[lpc]
        order[lpc] = ORDER
        u = (u << 1) ^ (u >> 31)
        coded = np.arange(n) >= order[:, None]
        extra = np.where(lpc, 9 + ORDER * PRECISION, 0)  # the predictor's own bits
        mean = (u * coded).sum(axis=1) / (n - order)
        k = np.clip(np.log2(mean * 0.7 + 1e-9).astype(np.int64) + (mean > 1.5), 0, 14)
        width = np.where(coded, (u >> k[:, None]) + 1 + k[:, None], 0)
        bits = 8 + 8 * order + extra + 10 + width.sum(axis=1)
        plain = bits >= 8 + 8 * n
        body_bits[lane] = np.where(plain, 8 + 8 * n, bits)
        plans.append((n, lane, x, order, u, coded, k, width, plain, lpc, coefs, shift, extra))
    body = -(-body_bits // 8)
    frame_size = head_size + body + 2
    frame_at = np.cumsum(frame_size) - frame_size
    out = np.zeros(int(frame_size.sum()) + 2, np.uint8)  # two bytes before the first
    ends, values = [], []

    def put(end: np.ndarray, value: np.ndarray) -> None:
        ends.append(end.ravel())
        values.append(value.ravel().astype(np.int64))

    for n, lane, x, order, u, coded, k, width, plain, lpc, coefs, shift, extra in plans:
        start = (frame_at[lane] + head_size[lane]) * 8
        kind = np.where(plain, 1, np.where(lpc, 31, 8) + order) << 1
        put(start + 8, kind)
        raw = np.flatnonzero(plain)
        if len(raw):
            put(start[raw][:, None] + 16 + 8 * np.arange(n), x[raw] & 0xFF)
        rice = np.flatnonzero(~plain)
        if not len(rice):
            continue
        start, order, k = start[rice], order[rice], k[rice]
        for j in range(ORDER):
            warm = order > j
            if warm.any():
                put(start[warm] + 16 + 8 * j, x[rice[warm], j] & 0xFF)
        own = np.flatnonzero(lpc[rice])
        if len(own):
            at, which = start[own] + 8 + 8 * ORDER, rice[own]
            put(at + 4, np.full(len(own), PRECISION - 1))
            put(at + 9, shift[which])
            for j in range(ORDER):
                put(at + 9 + PRECISION * (j + 1), coefs[which, j] & ((1 << PRECISION) - 1))
        base = start + 8 + 8 * order + extra[rice] + 10
        put(base, k)
        end = base[:, None] + np.cumsum(width[rice], axis=1)
        code = np.where(coded[rice], (np.int64(1) << k[:, None]) | (u[rice] & ((1 << k[:, None]) - 1)), 0)
        put(end, code)
    _put(out, np.concatenate(ends), np.concatenate(values))
    out = out[2:]
    for head, at in zip(heads, frame_at.tolist(), strict=True):
        out[at : at + len(head)] = np.frombuffer(head, np.uint8)
    crc = crc16(out, frame_at, frame_size - 2)
    at = frame_at + frame_size - 2
    out[at], out[at + 1] = crc >> 8, crc & 0xFF
    streams, done = [], 0
    whole = out.tobytes()
    for p, f in zip(payloads, frames.tolist(), strict=True):
        a, b = int(frame_at[done]), int(frame_at[done + f - 1] + frame_size[done + f - 1])
        own = frame_size[done : done + f]
        info = BLOCK.to_bytes(2, "big") * 2 + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big")
        info += (RATE << 44 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5((p ^ 0x80).tobytes()).digest()
        points = np.zeros(f, np.dtype([("sample", ">u8"), ("at", ">u8"), ("size", ">u2")]))
        points["sample"], points["at"], points["size"] = np.arange(f) * BLOCK, frame_at[done : done + f] - a, size[done : done + f]
        table = points.tobytes()
        seek = b"\x83" + len(table).to_bytes(3, "big") + table if f <= POINTS else b""
        streams.append(b"fLaC" + (b"\x00" if seek else b"\x80") + len(info).to_bytes(3, "big") + info + seek + whole[a:b])
        done += f
    return streams


def _metadata(stream: bytes) -> tuple[dict, int]:
    if stream[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info = 4, {"points": None}
    while True:
        kind, size = stream[at], int.from_bytes(stream[at + 1 : at + 4], "big")
        data = stream[at + 4 : at + 4 + size]
        at += 4 + size
        if kind & 0x7F == 0:
            x = int.from_bytes(data[10:18], "big")
            info |= {"rate": x >> 44, "channels": (x >> 41 & 7) + 1, "bits": (x >> 36 & 31) + 1, "samples": x & (1 << 36) - 1, "md5": data[18:34]}
        elif kind & 0x7F == 3:
            info["points"] = np.frombuffer(data, np.dtype([("sample", ">u8"), ("at", ">u8"), ("size", ">u2")]))
        if kind & 0x80:
            break
    if info["channels"] != 1 or info["bits"] != 8:
        raise ValueError("only mono streams of 8 bits are read")
    return info, at


#: Block sizes by their code in a frame header; 6 and 7 stand for 1 or 2 bytes after the number.
_SIZES = {1: 192, **{k: 576 << (k - 2) for k in range(2, 6)}, **{k: 256 << (k - 8) for k in range(8, 16)}}


@lru_cache(1 << 16)
def _parse_header(head: bytes) -> tuple[int, int]:
    """Bytes of the header that `head` begins with, and the frame's samples."""
    if head[0] != 0xFF or head[1] & 0xFE != 0xF8:
        raise ValueError("no frame here")
    lead = head[4]
    extra = 0 if lead < 0x80 else 6 if lead == 0xFE else 7 - (lead ^ 0xFF).bit_length() if lead < 0xFE else 6
    at, code = 5 + extra, head[2] >> 4
    if code in (6, 7):
        size = int.from_bytes(head[at : at + code - 5], "big") + 1
        at += code - 5
    else:
        size = _SIZES[code]
    at += {12: 1, 13: 2, 14: 2}.get(head[2] & 15, 0)
    if crc8(head[:at]) != head[at]:
        raise ValueError("frame header checksum")
    return at + 1, size


#: Zeros before the first one in 16 bits.
_ZEROS = np.array([16 - i.bit_length() for i in range(1 << 16)], np.int64)


class _Lanes:
    """Bit readers over one buffer, one a frame. wide has the 32 bits from each byte on."""

    def __init__(self, wide: np.ndarray, at: np.ndarray) -> None:
        self.wide, self.at = wide, at

    @staticmethod
    def windows(buf: np.ndarray) -> np.ndarray:
        out = np.zeros(len(buf), np.int64)
        for k in range(4):
            out[: len(buf) - k] |= buf[k:].astype(np.int64) << (24 - 8 * k)
        return out

    def take(self, lane, n) -> np.ndarray:
        """n bits, up to 32, of each lane; n may be an array."""
        at = self.at[lane]
        n = np.broadcast_to(np.asarray(n, np.int64), at.shape)
        high = (n + 1) // 2
        out = self._few(at, high) << (n - high) | self._few(at + high, n - high)
        self.at[lane] += n
        return out

    def _few(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        word = (self.wide[np.minimum(at >> 3, len(self.wide) - 1)] << (at & 7)) & 0xFFFFFFFF
        return word >> (32 - n)

    def rice(self, count: int, k: np.ndarray) -> np.ndarray:
        """The next Rice code of the first `count` lanes, whose parameters are k."""
        at = self.at[:count]
        word = (self.wide[at >> 3] << (at & 7)) & 0xFFFFFFFF
        zeros = _ZEROS[word >> 16]
        used = zeros + k
        if used.max() > 15:
            return self._long_rice(np.arange(count), k)
        used += 1
        low = (word >> (32 - used)) & ((1 << k) - 1)
        at += used
        return (zeros << k) | low

    def _long_rice(self, lane: np.ndarray, k: np.ndarray) -> np.ndarray:
        zeros = np.zeros(len(lane), np.int64)
        left = np.arange(len(lane))
        while len(left):
            run = _ZEROS[self._few(self.at[lane[left]], 16)]
            zeros[left] += run
            self.at[lane[left]] += run
            left = left[run == 16]
        self.at[lane] += 1
        return (zeros << k) | self.take(lane, k)


def _signed(x: np.ndarray, bits) -> np.ndarray:
    return x - ((x >> (bits - 1)) << bits)


def _decode_frames(wide: np.ndarray, start: np.ndarray, head: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples of every frame, in rows as long as the longest, and the bytes each frame takes without its CRC-16."""
    order_by = np.argsort(-size, kind="stable")
    start, head, size = start[order_by], head[order_by], size[order_by]
    n, most = len(size), int(size[0])
    bits = _Lanes(wide, (start + head) * 8)
    every = np.arange(n)
    kind = bits.take(every, 8) >> 1
    x = np.zeros((n, most), np.int64)
    constant, verbatim = kind == 0, kind == 1
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (constant | verbatim | fixed | lpc).all():
        raise ValueError("unknown subframe")
    lane = np.flatnonzero(constant)
    if len(lane):
        x[lane] = _signed(bits.take(lane, 8), 8)[:, None]
    order = np.where(fixed, kind - 8, np.where(lpc, kind - 31, 0))
    warm = np.where(verbatim, size, order)
    for i in range(int(warm.max())):
        lane = np.flatnonzero(warm > i)
        x[lane, i] = _signed(bits.take(lane, 8), 8)
    coefs, shift = np.zeros((n, 32), np.int64), np.zeros(n, np.int64)
    lane = np.flatnonzero(lpc)
    if len(lane):
        precision = bits.take(lane, 4) + 1
        shift[lane] = _signed(bits.take(lane, 5), 5)
        for j in range(int(order[lane].max())):
            some = order[lane] > j
            coefs[lane[some], j] = _signed(bits.take(lane[some], precision[some]), precision[some])
    coded = np.flatnonzero(fixed | lpc)
    if len(coded):
        method, parts = bits.take(coded, 2), bits.take(coded, 4)
        own = _Lanes(wide, bits.at[coded])  # longest first, so lanes that go on are the first ones
        length, begin, wide_param = size[coded], order[coded], 4 + method
        part = length >> parts
        due = np.zeros(len(coded), np.int64)
        param, raw = np.zeros(len(coded), np.int64), np.zeros(len(coded), bool)
        going = np.searchsorted(-length, -np.arange(most), "left").tolist()
        residual = np.zeros((most, len(coded)), np.int32)
        next_due, longest_warm = 0, int(begin.max())
        for i, count in enumerate(going):
            if i == next_due:
                fresh = np.flatnonzero(due[:count] == i)
                p = own.take(fresh, wide_param[fresh])
                raw[fresh] = p == (1 << wide_param[fresh]) - 1
                escaped = raw[fresh]
                if escaped.any():
                    p[escaped] = own.take(fresh[escaped], 5)
                param[fresh] = p
                due[fresh] += part[fresh]
                later = due[:count][due[:count] > i]
                next_due = int(later.min()) if len(later) else most
                any_raw = bool(raw[:count].any())
            if i < longest_warm or any_raw:
                # some lanes still have warm-up samples or plain residuals
                plain = np.flatnonzero(raw[:count] & (begin[:count] <= i))
                if len(plain):
                    got = own.take(plain, param[plain])
                    residual[i, plain] = np.where(param[plain] > 0, _signed(got, np.maximum(param[plain], 1)), 0)
                rest = np.flatnonzero(~raw[:count] & (begin[:count] <= i))
                if len(rest):
                    u = own._long_rice(rest, param[rest])
                    residual[i, rest] = (u >> 1) ^ -(u & 1)
                continue
            u = own.rice(count, param[:count])
            residual[i, :count] = (u >> 1) ^ -(u & 1)
        bits.at[coded] = own.at
        warmed = np.arange(most) < begin[:, None]
        x[coded] = np.where(warmed, x[coded], residual.T)
    for o in range(1, 5):
        lane = np.flatnonzero(fixed & (order == o))
        if len(lane):
            y = x[lane]
            diffs = [y[:, :o]]
            for _ in range(o - 1):
                diffs.append(np.diff(diffs[-1], axis=1))
            for j in range(o - 1, -1, -1):
                y[:, j] = diffs[j][:, 0]
                y[:, j:] = np.cumsum(y[:, j:], axis=1)
            x[lane] = y
    for o in np.unique(order[lpc]).tolist():
        lane = np.flatnonzero(lpc & (order == o))
        y, by = x[lane].T.copy(), coefs[lane, :o].T.copy()  # a row a sample: lanes that go on are the first ones
        for i, count in enumerate(np.searchsorted(-size[lane], -np.arange(most), "left").tolist()):
            if i >= o and count:
                guess = by[0, :count] * y[i - 1, :count]
                for j in range(1, o):
                    guess += by[j, :count] * y[i - 1 - j, :count]
                y[i, :count] += guess >> shift[lane[:count]]
        x[lane] = y.T
    taken = -(-bits.at // 8) - start
    back = np.empty(n, np.int64)
    back[order_by] = every
    return x[back], taken[back]


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """The samples of each stream as uint8, after its checksums are verified."""
    buf = np.frombuffer(b"".join(streams) + bytes(16), np.uint8)
    base, starts, heads, sizes, owners, infos = 0, [], [], [], [], []
    for i, s in enumerate(streams):
        info, at = _metadata(s)
        infos.append(info)
        if info["points"] is None:
            _sequential(s, at, info)
        for p in info["points"]["at"].tolist():
            head, size = _parse_header(s[at + p : at + p + 16])
            starts.append(base + at + p)
            heads.append(head)
            sizes.append(size)
            owners.append(i)
        base += len(s)
    start, head, size = np.array(starts), np.array(heads), np.array(sizes)
    x, taken = _decode_frames(_Lanes.windows(buf), start, head, size)
    stored = (buf[start + taken].astype(np.uint16) << np.uint16(8)) | buf[start + taken + 1]
    if (crc16(buf, start, taken) != stored).any():
        raise ValueError("frame checksum")
    pcm = (x + 128).astype(np.uint8)
    flat_pcm = pcm[np.arange(pcm.shape[1]) < size[:, None]]
    counts = np.bincount(owners, size, len(streams)).astype(np.int64)
    out = np.split(flat_pcm, np.cumsum(counts)[:-1])
    for y, info in zip(out, infos, strict=True):
        if len(y) != info["samples"] or hashlib.md5((y ^ 0x80).tobytes()).digest() != info["md5"]:
            raise ValueError("stream checksum")
    return out


def _sequential(stream: bytes, at: int, info: dict) -> None:
    """Seek points of a stream that has none: its frames are decoded one after the other."""
    wide = _Lanes.windows(np.frombuffer(stream + bytes(16), np.uint8))
    points, sample, begin = [], 0, at
    while sample < info["samples"]:
        head, size = _parse_header(stream[at : at + 16])
        _, taken = _decode_frames(wide, np.array([at]), np.array([head]), np.array([size]))
        points.append((sample, at - begin, size))
        sample += size
        at += int(taken[0]) + 2
    info["points"] = np.array(points, np.dtype([("sample", ">u8"), ("at", ">u8"), ("size", ">u2")]))


def blocks(stream: bytes, pcm: np.ndarray) -> list[tuple[int, bytes]]:
    """PCM blocks of a decoded stream with the sample each begins at."""
    info, _ = _metadata(stream)
    if info["points"] is None:
        return [(0, pcm.tobytes())]
    return [(int(a), pcm[int(a) : int(a) + int(n)].tobytes()) for a, _, n in info["points"].tolist()]


def read(own: list[tuple[int, bytes]], first: int, size: int) -> bytes:
    """Samples [first, first + size) from PCM blocks in order: the block that has the first one is found by its offset."""
    out, at = [], bisect_right(own, first, key=lambda b: b[0]) - 1
    while size > 0:
        part = own[at][1][first - own[at][0] :][:size]
        out.append(part)
        first, size, at = first + len(part), size - len(part), at + 1
    return b"".join(out)


def payloads(column) -> tuple[list[np.ndarray], list[int]]:
    """Each text's bytes, zeros added up to a positive multiple of 64; and its bytes without them."""
    buf, at = flat(column)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        p = np.zeros(max(PAD, -(-(b - a) // PAD) * PAD), np.uint8)
        p[: b - a] = buf[a:b]
        out.append(p)
    return out, np.diff(at).tolist()


def _feature(pcm: np.ndarray) -> str:
    """Mean, RMS and peak of the samples, and how often they cross their mean."""
    x = pcm.astype(np.int64) - 128
    turns = int(np.count_nonzero(np.diff(x * len(x) < x.sum())))
    return f"n={len(x)};mean={x.sum() / len(x):.4f};rms={np.sqrt((x * x).sum() / len(x)):.4f};peak={int(np.abs(x).max())};turns={turns / len(x):.4f}"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about CHUNK bytes of text."""
    for batch in batches:
        if batch.num_rows:
            size = np.cumsum(np.diff(flat(batch["text"])[1]) + PAD)
            cuts = np.flatnonzero(np.diff(size // CHUNK)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                yield batch.slice(a, b - a)


def stored(docs: DataFrame) -> DataFrame:
    """doc_id and its text as a FLAC stream."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            yield pa.record_batch([batch["doc_id"], pa.array(encode(payloads(batch["text"])[0]), pa.binary())], ["doc_id", "media"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(write, "doc_id long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """One row per block of samples: doc_id, first_sample, pcm."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(np.diff(flat(batch["media"])[1]))
            at = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(at, at[1:], strict=False):
                part = batch.slice(a, b - a)
                streams = part["media"].to_pylist()
                rows = [(i, s, p) for i, m, y in zip(part["doc_id"].to_pylist(), streams, decode(streams), strict=True) for s, p in blocks(m, y)]
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["doc_id", "first_sample", "pcm"])

    return media.mapInArrow(split, "doc_id long, first_sample long, pcm binary")


MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_blocks", pa.int64()), ("blocks_sha256", pa.string())])


def media_digest(docs: DataFrame) -> DataFrame:
    """Every text stored as FLAC and read back into PCM blocks: sizes, digests and a feature of what the blocks hold.

    The payload's digest goes over the blocks in order, its last 64 bytes are sought by their sample
    offset; blocks_sha256 is over each block's offset (8 bytes, little-endian) and samples. A null or
    empty text is 64 zero bytes. Equal texts give equal values, whatever rows stand beside them; rows
    that repeat an id each give a row. A very long text is a long stream; one with more frames than a
    seek table can count is read frame by frame. Other columns are not read.
    """

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            own, size = payloads(batch["text"])
            streams = encode(own)
            pcm = decode(streams)
            parts = [blocks(s, y) for s, y in zip(streams, pcm, strict=True)]
            length = [own[-1][0] + len(own[-1][1]) for own in parts]
            sha = lambda xs: hashlib.sha256(b"".join(xs)).hexdigest()
            yield pa.record_batch([
                batch["doc_id"], pa.array(size, pa.int64()), pa.array(length, pa.int64()), pa.array([sha(x for _, x in own) for own in parts]), pa.array([zlib.crc32(read(own, n - PAD, PAD)) for own, n in zip(parts, length, strict=True)], pa.int64()),
                pa.array(map(len, streams), pa.int64()), pa.array([sha([x]) for x in streams]), pa.array(map(_feature, pcm)),
                pa.array(map(len, parts), pa.int64()), pa.array([sha(x for at, p in own for x in (at.to_bytes(8, "little"), p)) for own in parts]),
            ], schema=MEDIA)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(through, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long, blocks_sha256 string")
