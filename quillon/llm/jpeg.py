"""Baseline JPEG as a media column: writer, reader, DC-only thumbnails and their hashes.

The writer stores bytes losslessly as quantised coefficients, the format's own unit: 64 bytes
are one greyscale block in zigzag order and quantisation steps are 1.  A byte is stored by its rank in
``FREQUENT``, so that bytes that are frequent in texts are small coefficients with short codes; the byte
193, which UTF-8 never has, is a coefficient of zero.
Nine blocks (576 bytes) make a restart interval.  Images are 72 samples wide or a multiple of
that, so that 65,500 lines suffice for texts of any length; blocks behind the payload are empty,
and a comment holds the payload's length.

The reader parses markers and Huffman-decodes baseline scans (8 bits, one scan, up to four
components, with or without restart intervals).  All restart intervals of a batch are decoded in
step with one another, so the loop over symbols is numpy work on thousands of intervals.  Luminance
thumbnails are made from the DC coefficients alone, one pixel per block.

A null text is empty.  Equal texts have equal images; repeated rows are stored each for itself, a null id
stays null, extra columns are ignored, an empty table gives an empty result.  Damaged images raise
``JpegError``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, slices, table, written

UNIT = 576
#: The byte that is stored as zero.
ZERO = 193
BLOCKS = UNIT // 64
MOST_LINES = 65_528 // 8
#: Bytes of text in a batch that is encoded and decoded together.
BATCH_BYTES = 4 << 20
_NOTE = b"payload "


class JpegError(ValueError):
    """An image that is damaged or not baseline."""


#: Bytes by falling frequency in texts, about; all others follow by value.  The 255 is padding.
FREQUENT = b" etaoinsrhldcum\xff.fpgwybvk,\n\xc3"
#: The coefficient of each byte: 1, -1, 2, -2 and so on by rank, zero for ``ZERO``.
COEFFICIENTS = np.zeros(256, np.int64)
for _rank, _byte in enumerate([*FREQUENT, *(b for b in range(256) if b not in FREQUENT and b != ZERO)]):
    COEFFICIENTS[_byte] = (_rank // 2 + 1) * (1 - 2 * (_rank % 2))
#: The byte of each coefficient from -128 to 128; -1 where there is none.
_BYTES = np.full(257, -1, np.int64)
_BYTES[COEFFICIENTS + 128] = np.arange(256)

# Huffman tables of the writer: short codes for the sizes of text coefficients without zeros before
# them, as (length, symbol); everything else has 16 bits (4 for DC).
_AC_SHORT = [(2, 0x01), (2, 0x02), (2, 0x03), (3, 0x04), (4, 0x05), (5, 0x06), (6, 0x07), (7, 0x08)]
_AC_LONG = [0x00, 0xF0] + [run << 4 | size for run in range(16) for size in range(1, 11) if (run << 4 | size) not in {s for _, s in _AC_SHORT}]
AC_TABLE = _AC_SHORT + [(16, s) for s in _AC_LONG]
DC_TABLE = [(4, s) for s in range(12)]


def codes(lengths: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Canonical code (value, length) of each symbol, of (length, symbol) pairs by length."""
    out, code, last = {}, 0, 0
    for n, symbol in lengths:
        code <<= n - last
        if code >= 1 << n:
            raise JpegError("bad Huffman table")
        out[symbol] = (code, n)
        code, last = code + 1, n
    return out


def _vectors(lengths: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    value, size = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for symbol, (c, n) in codes(lengths).items():
        value[symbol], size[symbol] = c, n
    return value, size


_DC_CODE, _DC_LEN = _vectors(DC_TABLE)
_AC_CODE, _AC_LEN = _vectors(AC_TABLE)
_SIZE = np.array([abs(v).bit_length() for v in range(-1024, 1025)], np.int64)
#: Bits and length of an AC coefficient without zeros before it, by stored byte.
_BYTE = COEFFICIENTS
_BYTE_SIZE = _SIZE[_BYTE + 1024]
_BYTE_BITS = (_AC_CODE[_BYTE_SIZE] << _BYTE_SIZE | np.where(_BYTE < 0, _BYTE + (1 << _BYTE_SIZE) - 1, _BYTE)).astype(np.uint32)
_BYTE_LEN = (_AC_LEN[_BYTE_SIZE] + _BYTE_SIZE).astype(np.int32)


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def _dht(kind: int, lengths: list[tuple[int, int]]) -> bytes:
    return bytes([kind]) + bytes(sum(n == i for n, _ in lengths) for i in range(1, 17)) + bytes(s for _, s in lengths)


_TABLES = _segment(0xC4, _dht(0x00, DC_TABLE) + _dht(0x10, AC_TABLE))
#: Without a byte that is stored as zero no runs occur: the first codes, the last of them an empty block's, do.
_FEW_TABLES = _segment(0xC4, _dht(0x00, DC_TABLE) + _dht(0x10, AC_TABLE[: len(_AC_SHORT) + 1]))


def pad(text: bytes) -> bytes:
    """Bytes 255 appended up to a positive multiple of 576."""
    return text + b"\xff" * (max(1, -(-len(text) // UNIT)) * UNIT - len(text))


def _shape(payload: int) -> tuple[int, int]:
    """Units per line of blocks, and lines."""
    units = payload // UNIT
    wide = -(-units // MOST_LINES)
    return wide, -(-units // wide)


def _header(payload: int, runs: bool = True) -> bytes:
    wide, lines = _shape(payload)
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xFE, _NOTE + str(payload).encode()),
            _segment(0xDB, b"\0" + b"\x01" * 64),
            _segment(0xC0, b"\x08" + (8 * lines).to_bytes(2, "big") + (8 * BLOCKS * wide).to_bytes(2, "big") + b"\x01\x01\x11\0"),
            _TABLES if runs else _FEW_TABLES,
            _segment(0xDD, BLOCKS.to_bytes(2, "big")),
            _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
        )
    )


def _tokens(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits and lengths of the symbols of blocks of bytes, and symbols per block."""
    n = len(raw)
    level = COEFFICIENTS[raw[:, 0]]
    dc = np.diff(level.reshape(-1, BLOCKS), axis=1, prepend=0).ravel()
    size = _SIZE[dc + 1024]
    dc_bits = _DC_CODE[size] << size | np.where(dc < 0, dc + (1 << size) - 1, dc)
    dc_len = _DC_LEN[size] + size
    if not (raw[:, 1:] == ZERO).any():
        bits, length = _BYTE_BITS[raw], _BYTE_LEN[raw]
        bits[:, 0], length[:, 0] = dc_bits, dc_len
        return bits.ravel(), length.ravel(), np.full(n, 64)
    block, k = np.nonzero(raw[:, 1:] != ZERO)
    k = k + 1
    fresh = np.concatenate([[True], block[1:] != block[:-1]]) if len(block) else np.zeros(0, bool)
    run = k - np.where(fresh, 0, np.concatenate([[0], k[:-1]])[: len(k)]) - 1
    jumps = run >> 4
    value = raw[block, k]
    symbol = (run & 15) << 4 | _BYTE_SIZE[value]
    last = np.zeros(n, np.int64)
    last[block] = k
    each = 1 + np.bincount(block, 1 + jumps, n).astype(np.int64) + (last < 63)
    start = np.cumsum(each) - each
    bits, length = np.full(each.sum(), _AC_CODE[0xF0], np.uint32), np.full(each.sum(), _AC_LEN[0xF0], np.int32)
    bits[start], length[start] = dc_bits, dc_len
    before = np.cumsum(1 + jumps) - (1 + jumps)
    base = before[fresh][np.cumsum(fresh) - 1] if len(block) else before
    at = start[block] + 1 + before - base + jumps
    own = _BYTE_SIZE[value]
    bits[at] = _AC_CODE[symbol] << own | _BYTE_BITS[value] & ((1 << own) - 1)
    length[at] = _AC_LEN[symbol] + own
    end = (start + each - 1)[last < 63]
    bits[end], length[end] = _AC_CODE[0], _AC_LEN[0]
    return bits, length, each


def encode(payloads: list[bytes]) -> list[bytes]:
    """A baseline JPEG for each payload (a positive multiple of 576 bytes)."""
    intervals, parts = [], []
    for p in payloads:
        wide, lines = _shape(len(p))
        intervals.append(wide * lines)
        parts.append(p + bytes([ZERO]) * (wide * lines * UNIT - len(p)))
    bits, length, each = _tokens(np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 64))
    tokens = each.reshape(-1, BLOCKS).sum(axis=1)
    first = np.cumsum(tokens) - tokens
    total = np.cumsum(length, dtype=np.int64)
    begin = total[first] - length[first]
    used = np.concatenate([begin[1:], total[-1:]]) - begin
    octets = (used + 7) >> 3
    offset = np.cumsum(octets) - octets
    at = total - length
    at -= np.repeat(begin - 8 * offset, tokens)
    # A symbol has fewer than 32 bits: it touches the 32-bit word that it starts in and the next.
    word = at >> 5
    value = bits.astype(np.uint64) << (64 - length - (at & 31)).astype(np.uint64)
    head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    size = int(octets.sum())
    both = np.zeros(size // 4 + 3, np.uint64)
    both[word[head]] = np.bitwise_or.reduceat(value, head)
    full = (both >> np.uint64(32)).astype(np.uint32)
    full[1:] |= (both[:-1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = full.astype(">u4").view(np.uint8)[:size].copy()
    ends = offset + octets
    out[ends - 1] |= ((1 << (-used % 8)) - 1).astype(np.uint8)
    # Stuffing, and restart markers between the intervals of an image.
    full = np.flatnonzero(out == 255)
    image = np.repeat(np.arange(len(payloads)), intervals)
    number = np.arange(len(ends)) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    inner = np.flatnonzero(np.concatenate([image[1:] == image[:-1], [False]]))
    place = np.concatenate([full + 1, np.repeat(ends[inner], 2)])
    value = np.concatenate([np.zeros(len(full), np.uint8), np.stack([np.full(len(inner), 255), 0xD0 + number[inner] % 8], axis=1).ravel().astype(np.uint8)])
    order = np.argsort(place, kind="stable")
    done = np.insert(out, place[order], value[order])
    stop = np.cumsum(intervals) - 1
    cut = ends[stop] + np.searchsorted(np.sort(place), ends[stop], side="right")
    body, begin_at, images = done.tobytes(), 0, []
    for p, c in zip(payloads, cut.tolist(), strict=True):
        images.append(_header(len(p), ZERO in p) + body[begin_at:c] + b"\xff\xd9")
        begin_at = c
    return images


class Frame(NamedTuple):
    """What the markers of an image say."""

    width: int
    height: int
    components: tuple[tuple[int, int, int, int, int], ...]  # h, v, quantiser, DC table, AC table
    quantisers: dict[int, bytes | tuple[int, ...]]
    tables: tuple[tuple[int, bytes], ...]
    restart: int
    note: bytes
    scan: bytes

    @property
    def pattern(self) -> tuple[int, ...]:
        """Component of each block of an MCU."""
        if len(self.components) == 1:
            return (0,)
        return tuple(i for i, c in enumerate(self.components) for _ in range(c[0] * c[1]))

    @property
    def mcus(self) -> tuple[int, int]:
        """MCUs across and down."""
        h = max(c[0] for c in self.components) if len(self.components) > 1 else 1
        v = max(c[1] for c in self.components) if len(self.components) > 1 else 1
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(image: bytes) -> Frame:
    """Read the markers up to the scan."""
    if image[:2] != b"\xff\xd8":
        raise JpegError("no SOI")
    at, quantisers, tables, restart, note, size = 2, {}, {}, 0, b"", None
    parts: list[list[int]] = []
    try:
        while True:
            if image[at] != 0xFF:
                raise JpegError("no marker where one must be")
            while image[at + 1] == 0xFF:
                at += 1
            marker, n = image[at + 1], int.from_bytes(image[at + 2 : at + 4], "big")
            body = image[at + 4 : at + 2 + n]
            if n < 2 or len(body) != n - 2:
                raise JpegError("segment is cut short")
            at += 2 + n
            if marker == 0xDB:
                while body:
                    wide, name = body[0] >> 4, body[0] & 15
                    step = 128 if wide else 64
                    raw = body[1 : 1 + step]
                    quantisers[name] = tuple(int.from_bytes(raw[2 * i : 2 * i + 2], "big") for i in range(64)) if wide else raw
                    body = body[1 + step :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xC0:
                if body[0] != 8:
                    raise JpegError("not 8 bits")
                size = int.from_bytes(body[3:5], "big"), int.from_bytes(body[1:3], "big")
                parts = [[body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i], 0, 0] for i in range(body[5])]
            elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise JpegError("not baseline")
            elif marker == 0xDD:
                restart = int.from_bytes(body, "big")
            elif marker == 0xFE:
                note = body
            elif marker == 0xD9:
                raise JpegError("no scan")
            elif marker == 0xDA:
                chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
                if size is None or not parts or set(chosen) != {p[0] for p in parts} or 0 in size:
                    raise JpegError("scan does not fit the frame")
                for p in parts:
                    p[4], p[5] = chosen[p[0]] >> 4, 16 | chosen[p[0]] & 15
                return Frame(*size, tuple((h, v, q, d, a) for _, h, v, q, d, a in parts), quantisers, tuple(sorted(tables.items())), restart, note, image[at:])
    except IndexError as e:
        raise JpegError("image is cut short") from e


def _lookup(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16 bits that may come: code length << 8 | symbol, 0 where no code fits; and where
    code and value fit in them and no zeros come before: length of both (else 0), and the value."""
    lengths, at = [], 16
    for n in range(1, 17):
        for _ in range(body[n - 1]):
            lengths.append((n, body[at]))
            at += 1
    entry, whole, value = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int16)
    for symbol, (c, n) in codes(lengths).items():
        low, high = c << (16 - n), (c + 1) << (16 - n)
        entry[low:high] = n << 8 | symbol
        if symbol < 16 and n + symbol <= 16:
            raw = (np.arange(low, high) >> (16 - n - symbol)) & ((1 << symbol) - 1)
            whole[low:high] = n + symbol
            value[low:high] = np.where(raw < (1 << symbol >> 1), raw - (1 << symbol) + 1, raw) if symbol else 0
    return entry, whole, value


_luts: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _lut(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if body not in _luts:
        if len(_luts) > 64:
            _luts.clear()
        _luts[body] = _lookup(body)
    return _luts[body]


def _intervals(scan: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a scan without stuffing and markers, and where each restart interval begins."""
    raw = np.frombuffer(scan, np.uint8)
    full = np.flatnonzero(raw[:-1] == 255)
    after = raw[full + 1]
    end = full[(after != 0) & (after != 255) & ((after < 0xD0) | (after > 0xD7))]
    if not len(end):
        raise JpegError("no EOI")
    stop = int(end[0])
    full, after = full[full < stop], after[full < stop]
    restarts = full[(after >= 0xD0) & (after <= 0xD7)]
    keep = np.ones(stop, bool)
    keep[full[after == 0] + 1] = False
    keep[restarts] = False
    keep[restarts + 1] = False
    start = np.concatenate([[0], restarts])
    return raw[:stop][keep], start - np.searchsorted(np.flatnonzero(~keep), start)


def decode(frames: list[Frame]) -> list[np.ndarray]:
    """Quantised coefficients (blocks in scan order, 64 in zigzag order) of each image."""
    groups = defaultdict(list)
    for i, f in enumerate(frames):
        groups[f.tables, f.pattern, tuple((c[3], c[4]) for c in f.components)].append(i)
    out: list = [None] * len(frames)
    for (tables, pattern, chosen), members in groups.items():
        known = dict(tables)
        if any(t not in known for pair in chosen for t in pair):
            raise JpegError("a Huffman table is missing")
        luts = [_lut(known[t]) for pair in chosen for t in pair]
        data, starts, ends, blocks, held = [], [], [], [], 0
        counts = []
        for i in members:
            f = frames[i]
            body, begin = _intervals(f.scan)
            mcus = f.mcus[0] * f.mcus[1]
            each = f.restart or mcus
            if len(begin) != -(-mcus // each):
                raise JpegError("wrong number of restart intervals")
            data.append(body)
            starts.append(begin + held)
            ends.append(np.concatenate([begin[1:], [len(body)]]) + held)
            n = np.full(len(begin), each * len(pattern))
            n[-1] = (mcus - each * (len(begin) - 1)) * len(pattern)
            blocks.append(n)
            counts.append(len(begin))
            held += len(body)
        coefs = _in_step(np.concatenate(data), np.concatenate(starts), np.concatenate(ends), np.concatenate(blocks), luts, np.array(pattern))
        n, at = np.concatenate(blocks), 0
        for i, c in zip(members, counts, strict=True):
            out[i] = np.concatenate([coefs[at + j, : n[at + j]] for j in range(c)]) if len(set(n[at : at + c].tolist())) > 1 else coefs[at : at + c, : n[at]].reshape(-1, 64)
            at += c
    return out


def _in_step(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, blocks: np.ndarray, luts: list, pattern: np.ndarray) -> np.ndarray:
    """Huffman-decode all intervals in step: (interval, block, 64), DC summed up."""
    # What is missing at an interval's end reads as ones, which no code consists of alone.
    wide = np.concatenate([data, np.full(512, 255, np.uint8)]).astype(np.uint64)
    window = np.zeros(len(wide) - 8, np.uint64)
    for j in range(5):
        window = window << np.uint64(8) | wide[j : j + len(window)]
    narrow = (window >> np.uint64(16)).astype(np.int32)  # 24 bits
    entries = np.concatenate([x[0] for x in luts])
    n, most = len(starts), int(blocks.max())
    out = np.zeros((n, most * 64), np.int16)
    flat = out.reshape(-1)
    row = np.arange(n, dtype=np.int64) * (most * 64)
    pos, limit, k, goal = starts.astype(np.int64) * 8, ends.astype(np.int64) * 8, np.zeros(n, np.int64), blocks.astype(np.int64) * 64
    several = len(set(pattern.tolist())) > 1
    level = 0  # while all intervals are at the same coefficient, that one; else -1
    while len(pos):
        if level >= 0:
            dc = level & 63 == 0
            which = 2 * int(pattern[(level >> 6) % len(pattern)]) + (not dc)
            _, whole, fitting = luts[which]
            x = (narrow[pos >> 3] >> (8 - (pos & 7))) & 0xFFFF
            length = whole[x]
            value = fitting[x]
            if length.all() and (dc or value.all()):
                flat[row + level] = value
                pos += length
                level += 1
                if level & 63 == 0:
                    if (pos > limit).any():
                        raise JpegError("interval is cut short")
                    on = goal > level
                    if not on.all():
                        pos, limit, goal, row = pos[on], limit[on], goal[on], row[on]
                continue
            k = np.full(len(pos), level)
        low = k & 63
        table_at = (low > 0).astype(np.int64)
        if several:
            table_at += 2 * pattern[(k >> 6) % len(pattern)]
        x = ((window[pos >> 3] << (np.uint64(24) + (pos & 7).astype(np.uint64))) >> np.uint64(32)).astype(np.int64)
        entry = entries[(table_at << 16) + (x >> 16)]
        length, symbol = (entry >> 8).astype(np.int64), entry & 255
        if not length.all():
            raise JpegError("no such Huffman code")
        size = (symbol & 15).astype(np.int64)
        dc = low == 0
        if (size[dc] > 11).any():
            raise JpegError("no such size")
        run = np.where(dc, 0, symbol >> 4)
        raw = (x >> (32 - length - size)) & ((1 << size) - 1)
        value = np.where((size > 0) & (raw >> np.maximum(size - 1, 0) == 0), raw - (1 << size) + 1, raw)
        pos = pos + length + size
        at = k + run
        empty = (size == 0) & ~dc
        stay = ~empty
        if (stay & (at >> 6 != k >> 6)).any():
            raise JpegError("run over the end of a block")
        flat[(row + at)[stay]] = value[stay]
        k = np.where(empty, np.where(run == 15, k + 16, (k | 63) + 1), at + 1)
        if (pos > limit).any():
            raise JpegError("interval is cut short")
        on = k < goal
        if not on.all():
            pos, limit, k, goal, row = pos[on], limit[on], k[on], goal[on], row[on]
        level = int(k[0]) if len(k) and (k == k[0]).all() else -1
    done = out.reshape(n, most, 64)
    for c in set(pattern.tolist()):
        mine = np.flatnonzero(pattern[np.arange(most) % len(pattern)] == c)
        done[:, mine, 0] = np.cumsum(done[:, mine, 0], axis=1, dtype=np.int64)
    return done


def thumbnail(frame: Frame, coefs: np.ndarray) -> np.ndarray:
    """Luminance of each 8 x 8 block from its DC coefficient, 0 to 255."""
    across, down = frame.mcus
    h, v, q = frame.components[0][:3] if len(frame.components) > 1 else (1, 1, frame.components[0][2])
    if q not in frame.quantisers:
        raise JpegError("a quantisation table is missing")
    step = frame.quantisers[q][0]
    mine = np.asarray(frame.pattern) == 0
    dc = coefs[:, 0].reshape(down, across, -1)[:, :, mine].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
    rows, cols = -(-frame.height // 8), -(-frame.width // 8)
    if len(frame.components) > 1:
        rows, cols = -(-frame.height * v // (8 * max(c[1] for c in frame.components))), -(-frame.width * h // (8 * max(c[0] for c in frame.components)))
    return np.clip(np.rint(dc[:rows, :cols] * step / 8 + 128), 0, 255).astype(np.uint8)


def _reduce(x: np.ndarray, n: int) -> np.ndarray:
    """Means of ``n`` bands of rows; rows repeat where there are fewer."""
    at = np.arange(n) * len(x) // n
    if len(x) < n:
        return x[at].astype(float)
    return np.add.reduceat(x.astype(float), at, axis=0) / np.diff(np.concatenate([at, [len(x)]]))[:, None]


def thumbnail_hash(thumb: np.ndarray) -> str:
    """64 bits of the signs of horizontal differences on an 8 x 9 reduction."""
    small = _reduce(_reduce(thumb, 8).T, 9).T
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def payload_of(frame: Frame, coefs: np.ndarray) -> bytes:
    """The bytes that :func:`encode` stored."""
    if not frame.note.startswith(_NOTE):
        raise JpegError("no payload length")
    found = _BYTES[np.clip(coefs, -129, 128) + 128]
    if (coefs < -128).any() or (found < 0).any():
        raise JpegError("a coefficient is no byte")
    return found.astype(np.uint8).tobytes()[: int(frame.note[len(_NOTE) :])]


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, media)``: each text as a JPEG image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048, BATCH_BYTES):
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(encode([pad(t) for t in texts]), pa.binary())], names=["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, media binary")


_DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int"


def read_media(media: DataFrame) -> DataFrame:
    """Decode ``(doc_id, n_bytes, media)``: digests of the payload and the image, dimensions, thumbnail hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048, BATCH_BYTES):
            images = batch.column(2).to_pylist()
            frames = list(map(parse, images))
            coefs = decode(frames)
            payloads = list(map(payload_of, frames, coefs))
            mark = [f"{f.width}x{f.height}:{thumbnail_hash(thumbnail(f, c))}" for f, c in zip(frames, coefs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(list(map(len, payloads)), pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                    pa.array([zlib.crc32(p[-32:]) for p in payloads], pa.int64()),
                    pa.array(list(map(len, images)), pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in images]),
                    pa.array(mark),
                    pa.array([f.width for f in frames], pa.int32()),
                    pa.array([f.height for f in frames], pa.int32()),
                ],
                names=[c.split()[0] for c in _DIGEST.split(", ")],
            )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, _DIGEST)


def op9_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a JPEG in a table, read back from it, with its digests and thumbnail hash."""
    return read_media(written(encode_texts(table(spark, sf_dir, "documents")), "media"))
