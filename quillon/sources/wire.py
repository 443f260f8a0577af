"""Container wire format: varints, backends, named streams, frames and the hash trailer."""

from __future__ import annotations

import hashlib
import lzma
from typing import NamedTuple

import zstandard

# Fixed values of the format.
MAGIC = b"AT1"
WHOLE, STREAM = 2, 3
RAW = 255
ZSTD, STORED, XZ = 1, 2, 0
TRAILER_MAGIC = b"\xa1S6\x01"
MOST_STREAMS, NAME_BYTES = 256, 31

#: Bytes that one decompression may give.
DEFAULT_CEILING = 16 << 30


class ArchiveError(ValueError):
    """A container that is not well formed."""

    code = 2


class BackendError(ArchiveError):
    """A compressed payload or a varint that is damaged, or a limit that is exceeded."""

    code = 3


class Cursor:
    """Reads from bytes, with bounds checks."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def done(self) -> bool:
        return self.at >= len(self.data)

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ArchiveError("stream is cut short")
        self.at += n
        return self.data[self.at - n : self.at]

    def byte(self) -> int:
        return self.take(1)[0]

    def uv(self) -> int:
        value = shift = 0
        while True:
            if self.at >= len(self.data) or shift > 63:
                raise BackendError("varint overrun")
            b = self.data[self.at]
            self.at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value & 0xFFFFFFFFFFFFFFFF
            shift += 7

    def sv(self) -> int:
        return unzigzag(self.uv())

    def lp(self) -> bytes:
        return self.take(self.uv())


def zigzag(v: int) -> int:
    return (v << 1) ^ (v >> 63)


def unzigzag(z: int) -> int:
    return (z >> 1) ^ -(z & 1)


def put_uv(v: int) -> bytes:
    out = bytearray()
    while v > 127:
        out.append(v & 127 | 128)
        v >>= 7
    out.append(v)
    return bytes(out)


def put_sv(v: int) -> bytes:
    return put_uv(zigzag(v) & 0xFFFFFFFFFFFFFFFF)


def put_lp(b: bytes) -> bytes:
    return put_uv(len(b)) + b


def expand(backend: int, data: bytes, ceiling: int = DEFAULT_CEILING) -> bytes:
    """Decompress by backend number; every number that is not known means xz."""
    if backend == STORED:
        return data
    try:
        if backend == ZSTD:
            size = zstandard.frame_content_size(data)
            if size < 0 or size > ceiling:
                raise BackendError("zstd size is not declared or too large")
            return zstandard.ZstdDecompressor().decompress(data, max_output_size=size) if size else b""
        reader = lzma.LZMADecompressor(lzma.FORMAT_XZ)
        out = reader.decompress(data, max_length=ceiling + 1)
        if len(out) > ceiling or not reader.eof:
            raise BackendError("xz payload is cut short or too large")
        return out
    except (lzma.LZMAError, zstandard.ZstdError, EOFError, MemoryError) as e:
        raise BackendError(str(e)) from e


def squeeze(data: bytes, backend: int = ZSTD) -> bytes:
    if backend == STORED:
        return data
    if backend == ZSTD:
        return zstandard.ZstdCompressor(level=3, write_content_size=True).compress(data)
    return lzma.compress(data, lzma.FORMAT_XZ)


class Stream(NamedTuple):
    """A named stream, not yet decompressed: place of its bytes in the body."""

    backend: int
    at: int
    size: int


def directory(body: bytes, at: int = 0) -> dict[str, Stream]:
    """Places of the named streams; the first of a name counts."""
    c = Cursor(body, at)
    count = c.uv()
    if count > MOST_STREAMS:
        raise ArchiveError("too many streams")
    out: dict[str, Stream] = {}
    for _ in range(count):
        name = c.lp()[:NAME_BYTES].decode("latin-1")
        backend, size = c.byte(), c.uv()
        c.take(size)
        out.setdefault(name, Stream(backend, c.at - size, size))
    return out


def unpack(body: bytes, ceiling: int = DEFAULT_CEILING) -> dict[str, bytes]:
    return {n: expand(s.backend, body[s.at : s.at + s.size], ceiling) for n, s in directory(body).items()}


def pack(streams: dict[str, bytes], backends: dict[str, int] | None = None) -> bytes:
    """Named streams; zstd where it is smaller unless a backend is given."""
    out = [put_uv(len(streams))]
    for name, data in streams.items():
        backend = (backends or {}).get(name)
        body = squeeze(data, ZSTD if backend is None else backend)
        if backend is None:
            backend, body = (ZSTD, body) if len(body) < len(data) else (STORED, data)
        out.append(put_lp(name.encode()) + bytes([backend]) + put_lp(body))
    return b"".join(out)


def whole(codec: int, streams: dict[str, bytes], backends: dict[str, int] | None = None) -> bytes:
    return MAGIC + bytes([WHOLE, codec]) + pack(streams, backends)


def raw(data: bytes, backend: int = ZSTD) -> bytes:
    return MAGIC + bytes([WHOLE, RAW, backend]) + squeeze(data, backend)


def stream(codec: int, frames: list[bytes], lines: int) -> bytes:
    """A container of frames; each is the body that :func:`pack` gives."""
    return MAGIC + bytes([STREAM, codec]) + put_uv(lines) + b"".join(put_uv(len(f) + 1) + b"\0" + f for f in frames)


def with_trailer(container: bytes, original: bytes) -> bytes:
    return container + hashlib.sha256(original).digest() + TRAILER_MAGIC


class Container(NamedTuple):
    """The framing of a container: codec, bodies (raw flag, bytes), and the hash if there is one."""

    kind: int
    codec: int
    bodies: list[tuple[bool, bytes]]
    sha256: bytes | None


def parse(blob: bytes | None) -> Container:
    if blob is None:
        raise ArchiveError("no input")
    digest = None
    if len(blob) >= 36 and blob[-4:] == TRAILER_MAGIC:
        digest, blob = blob[-36:-4], blob[:-36]
    if len(blob) < 5 or blob[:3] != MAGIC or blob[3] not in (WHOLE, STREAM):
        raise ArchiveError("not a container")
    codec = blob[4]
    if blob[3] == WHOLE:
        return Container(WHOLE, codec, [(codec == RAW, blob[5:])], digest)
    c, bodies = Cursor(blob, 5), []
    c.uv()
    while not c.done():
        frame = c.take(c.uv())  # the length counts the method byte
        if not frame:
            raise ArchiveError("empty frame")
        bodies.append((frame[0] == 1, frame[1:]))
    return Container(STREAM, codec, bodies, digest)


def open_raw(body: bytes, ceiling: int = DEFAULT_CEILING) -> bytes:
    if not body:
        raise ArchiveError("no backend byte")
    return expand(body[0], body[1:], ceiling)
