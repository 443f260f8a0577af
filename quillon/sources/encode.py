"""Encoders: tables, lines and arrays to verified containers."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable

import numpy as np

from . import codecs, wire
from .wire import put_lp, put_sv, put_uv

_INT = re.compile(rb"(0|-?[1-9][0-9]{0,17})\Z")
_DEC = re.compile(rb"-?(?:0|[1-9][0-9]{0,12})\.([0-9]{0,6})\Z")
#: Extra stream of ours: marks statistics as (least, most), doubles little-endian, and names the columns.
NAMES = "names"


def _deltas(values: Iterable[int]) -> bytes:
    out, last = [], 0
    for v in values:
        out.append(put_sv(v - last))
        last = v
    return b"".join(out)


def _unscaled(cell: bytes) -> int:
    return int(cell.replace(b".", b""))


def _scale_of(values: list[bytes]) -> int | None:
    """The scale that all values share and print with again, if any."""
    found = {len(m[1]) if (m := _DEC.match(v)) else None for v in values}
    scale = found.pop() if len(found) == 1 else None
    if scale is None or any(codecs.decimal_text(_unscaled(v), scale) != v for v in values):
        return None
    return scale


def numeric_or_exception(values: list[bytes]) -> bytes:
    """Integers as deltas, everything else as exceptions."""
    ok = [bool(_INT.match(v)) and b"%d" % int(v) == v for v in values]
    mask = bytearray((len(values) + 7) // 8)
    for i, x in enumerate(ok):
        mask[i >> 3] |= x << (i & 7)
    odd = [v for v, x in zip(values, ok, strict=True) if not x]
    return b"\0" + put_uv(len(values)) + bytes(mask) + put_uv(len(odd)) + b"".join(map(put_lp, odd)) + _deltas(int(v) for v, x in zip(values, ok, strict=True) if x)


def dictionary(values: list[bytes]) -> bytes:
    rank: dict[bytes, int] = {}
    picks = [rank.setdefault(v, len(rank)) for v in values]
    return put_uv(len(values)) + put_uv(len(rank)) + b"".join(map(put_lp, rank)) + b"".join(map(put_uv, picks))


def byte_planes(values: list[int]) -> bytes:
    least = min(values, default=0)
    shifted = [v - least for v in values]
    width = max(1, (max(shifted, default=0).bit_length() + 7) // 8)
    planes = b"".join(bytes(v >> (8 * p) & 255 for v in shifted) for p in range(width))
    return put_uv(len(values)) + put_sv(least) + bytes([width]) + planes


def derived(values: list[bytes], sources: list[list[bytes]]) -> tuple[int, bytes] | None:
    """The first earlier column that determines this one, and the map by first appearance."""
    for k, source in enumerate(sources):
        if len(source) != len(values):
            continue
        seen: dict[bytes, bytes] = {}
        if len(set(source)) * 4 <= len(source) and all(seen.setdefault(s, v) == v for s, v in zip(source, values, strict=True)):
            return k, put_uv(k) + put_uv(len(seen)) + b"".join(map(put_lp, seen.values()))
    return None


def column(values: list[bytes], earlier: list[list[bytes]]) -> tuple[int, bytes]:
    """Encoding number and bytes of a column; the smallest of those that restore it."""
    options: list[tuple[int, bytes]] = [(5, dictionary(values))]
    if values and not any(b"\n" in v for v in values):
        options.append((0, b"\n".join(values)))
    if values and all(_INT.match(v) and b"%d" % int(v) == v for v in values):
        options += [(1, _deltas(map(int, values))), (6, byte_planes(list(map(int, values))))]
    elif sum(bool(_INT.match(v)) for v in values) * 2 > len(values):
        options.append((3, numeric_or_exception(values)))
    elif values and (scale := _scale_of(values)) is not None:
        options.append((2, bytes([scale]) + _deltas(map(_unscaled, values))))
    if d := derived(values, earlier):
        options.append((4, d[1]))
    return min(options, key=lambda o: len(wire.squeeze(o[1])))


def columnar(header: bytes | None, rows: list[list[bytes] | bytes], quoted: list[list[bool] | bytes], delim: bytes, trailing: bool) -> bytes:
    """The tabular codec; a row is its fields, or bytes that are kept verbatim."""
    ncols = max((len(r) for r in rows if isinstance(r, list)), default=0)
    values: list[list[bytes]] = [[] for _ in range(ncols)]
    flags: list[list[bool]] = [[] for _ in range(ncols)]
    for r, q in zip(rows, quoted, strict=True):
        if isinstance(r, list):
            for i, v in enumerate(r):
                values[i].append(v)
                flags[i].append(q[i])
    kinds, bodies = bytearray(), []
    for i, v in enumerate(values):
        kind, body = column(v, values[:i])
        kinds.append(kind)
        bodies.append(body)
    modes = bytes(0 if not any(f) else 1 if all(f) else 2 for f in flags)
    bits = b"".join(np.packbits(f, bitorder="little").tobytes() for f, m in zip(flags, modes, strict=True) if m == 2)
    meta = put_uv(len(rows)) + bytes([trailing, header is not None]) + put_lp(delim) + put_uv(ncols)
    return wire.whole(
        4,
        {
            "meta": meta,
            "coltypes": bytes(kinds),
            "col_index": b"".join(put_uv(len(b)) for b in bodies),
            "values": b"".join(bodies),
            "quotemodes": modes,
            "quotebits": bits,
            "row_modes": bytes(isinstance(r, list) for r in rows),
            "fieldcounts": b"".join(put_uv(len(r)) for r in rows if isinstance(r, list)),
            "verbatim": b"\n".join(r for r in rows if not isinstance(r, list)),
            "header": header or b"",
        },
    )


def _statistics(kind: int, values: list[bytes]) -> bytes:
    """Least and most of a block; nulls and texts do not count.  NaN is above all numbers: infinite."""
    if kind == 1:
        known = [int(v) for v in values if _INT.match(v)] or [0]
        return put_sv(min(known)) + put_sv(max(known))
    if kind == 2:
        known_ = [float(v) for v in values if v and v != b"\\N"] or [0.0]
        known_ = [math.inf if math.isnan(v) else v for v in known_]
        return np.array([min(known_), max(known_)], "<f8").tobytes()
    return b""


def row_groups(columns: list[list[bytes]], kinds: list[int], group: int, *, delim: bytes | None = b",", template: list[bytes] | None = None, names: list | None = None, trailing: bool = True) -> dict[str, bytes]:
    """Streams of the queryable codecs: 7 with a delimiter, 8 with a template."""
    n = len(columns[0]) if columns else 0
    index, blocks = [], []
    for at in range(0, n, group):
        for col, kind in zip(columns, kinds, strict=True):
            part = col[at : at + group]
            block = b"\x01" + wire.squeeze(b"\n".join(part))
            index.append(put_uv(len(block)) + _statistics(kind, part))
            blocks.append(block)
    count = -(-n // group)
    head = put_uv(n) + bytes([trailing]) + (b"" if delim is None else put_lp(delim)) + put_uv(len(columns)) + put_uv(group) + put_uv(n) + put_uv(count) + bytes(kinds)
    out = {"meta": head, "row_modes": b"\x01" * n, "verbatim": b"", "index": b"".join(index)}
    if template is not None:
        out["template"] = put_uv(len(template)) + b"".join(map(put_lp, template))
    if names is not None:
        out[NAMES] = json.dumps(names).encode()
    return out | {"blocks": b"".join(blocks)}


def table(columns: list[list[bytes]], kinds: list[int], names: list, group: int, verify: bool = True) -> bytes:
    """A queryable table with a hash trailer; blocks are stored, so readers can seek to them."""
    s = row_groups(columns, kinds, group, delim=b"\x1f", names=names)
    out = wire.whole(7, s, {"blocks": wire.STORED, "meta": wire.STORED, "index": wire.STORED})
    original = codecs.qcolumnar(s)
    out = wire.with_trailer(out, original)
    if verify and codecs.decode(out) != original:
        raise wire.ArchiveError("the container does not restore its rows")
    return out


def embed(header: bytes, data: bytes, width: int) -> bytes:
    n = len(data) // width
    return wire.whole(10, {"meta": put_uv(width) + put_lp(header) + put_uv(n), "data": np.frombuffer(data, np.uint8).reshape(n, width).T.tobytes()})


def log(data: bytes) -> bytes:
    """Lines as templates with holes for numbers."""
    trailing, lines = data.endswith(b"\n"), data.removesuffix(b"\n").split(b"\n")
    rank: dict[bytes, int] = {}
    flags, ids, given, verbatim = bytearray(), [], [], []
    for line in lines:
        if b"\0" in line:
            flags.append(0)
            verbatim.append(line)
            continue
        flags.append(1)
        ids.append(put_uv(rank.setdefault(re.sub(rb"[0-9]+", b"\0", line), len(rank))))
        given += re.findall(rb"[0-9]+", line)
    meta = put_uv(len(lines)) + bytes([trailing])
    return wire.whole(3, {"meta": meta, "templates": b"\n".join(rank), "flags": bytes(flags), "tids": b"".join(ids), "vars": b"\n".join(given), "verbatim": b"\n".join(verbatim)})


_SCALAR = re.compile(rb'(?<=[:\[,])\s*("(?:[^"\\\n]|\\.)*"|-?[0-9][^,\]}\s]*|true|false|null)(?=\s*[,\]}])')


def qjson(data: bytes, group: int = 1024) -> bytes | None:
    """JSON lines that share one template, or nothing."""
    trailing, lines = data.endswith(b"\n"), data.removesuffix(b"\n").split(b"\n")
    template, rows = None, []
    for line in lines:
        found = list(_SCALAR.finditer(line))
        cuts = [0, *(x for m in found for x in m.span(1)), len(line)]
        literals = [line[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        template = template or literals
        if literals != template or not line.startswith(b"{"):
            return None
        rows.append([m[1] for m in found])
    columns = [list(c) for c in zip(*rows, strict=True)]
    kinds = [1 if all(_INT.match(v) for v in c) else 0 for c in columns]
    if not columns:
        return None
    return wire.whole(8, row_groups(columns, kinds, group, delim=None, template=template, trailing=trailing), {"blocks": wire.STORED})


def json_document(data: bytes) -> bytes:
    """A JSON text: its scalars in one column, the rest as skeleton."""
    raw = wire.whole(6, {"meta": b"\0", "raw": data})
    if b"\0" in data:
        return raw
    found = [m for m in _SCALAR.finditer(data) if b"\n" not in m[1]]
    if not found:
        return raw
    cuts = [0, *(x for m in found for x in m.span(1)), len(data)]
    skeleton = b"\0".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
    values = b"\n".join(m[1] for m in found)
    return wire.whole(6, {"meta": b"\1", "skeleton": skeleton, "colids": b"\0" * len(found), "value_index": b"\1" + put_uv(len(values)), "values": values})


def csv(data: bytes, delim: bytes = b",") -> bytes:
    """Delimited lines; a line whose fields cannot be restored is kept verbatim."""
    trailing, lines = data.endswith(b"\n"), data.removesuffix(b"\n").split(b"\n")
    rows: list = []
    flags: list = []
    field = re.compile(rb'"((?:[^"]|"")*)"|([^",\n]*)' if delim == b"," else rb'"((?:[^"]|"")*)"|([^"\t\n]*)')
    for line in lines[1:]:
        at, cells, quotes = 0, [], []
        while True:
            m = field.match(line, at)
            quotes.append(m[1] is not None)
            cells.append(m[1].replace(b'""', b'"') if m[1] is not None else m[2])
            at = m.end()
            if at >= len(line) or line[at : at + 1] != delim:
                break
            at += 1
        whole = at == len(line)
        rows.append(cells if whole else line)
        flags.append(quotes if whole else b"")
    return columnar(lines[0], rows, flags, delim, trailing)


def bundle(entries: list[tuple[str, bytes]]) -> bytes:
    """Containers under names that stay inside a folder."""
    for name, _ in entries:
        if not codecs.safe_name(name):
            raise wire.ArchiveError("unsafe entry name")
    manifest = json.dumps([{"name": n} for n, _ in entries]).encode()
    # The manifest comes last, so that an entry's trailer is not taken for the bundle's.
    return wire.whole(12, {f"e{i}": b for i, (_, b) in enumerate(entries)} | {"manifest": manifest}, {f"e{i}": wire.STORED for i in range(len(entries))})


def frames(parts: list[bytes], codec: int = 3) -> bytes:
    """A container of frames, each a part of the text compressed for itself."""
    return wire.MAGIC + bytes([wire.STREAM, codec]) + put_uv(0) + b"".join(put_uv(len(f) + 2) + b"\x01\x01" + f for f in map(wire.squeeze, parts))


def detect(data: bytes) -> list[str]:
    """Structures that a text may have, best guess first."""
    head = data[:4096].split(b"\n")
    out = []
    if head[0].startswith(b"{") and len(head) > 1:
        out.append("qjson")
    if head[0][:1] in (b"{", b"["):
        out.append("json")
    if len(head) > 2 and head[0].count(b",") and len({h.count(b",") for h in head[:-1]}) <= 2:
        out.append("csv")
    if len(head) > 2:
        out.append("log")
    return out


_ENCODERS = {"qjson": qjson, "json": json_document, "csv": csv, "log": log}


def best(data: bytes) -> bytes:
    """The smallest verified container; never larger than the plainly compressed one."""
    options = [wire.raw(data, wire.ZSTD), wire.raw(data, wire.XZ)]
    for kind in detect(data):
        made = _ENCODERS[kind](data)
        if made is not None and codecs.decode(made) == data:
            options.append(made)
    return wire.with_trailer(min(options, key=len), data)
