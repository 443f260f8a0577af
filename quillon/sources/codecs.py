"""Decoders: named streams to the original bytes, one function for each codec."""

from __future__ import annotations

import datetime
import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np

from . import wire
from .wire import ArchiveError, Cursor

Streams = dict[str, bytes]
DEPTH = 8192


def cells(data: bytes) -> list[bytes]:
    """Newline-joined cells; no bytes are one empty cell."""
    return data.split(b"\n")


def _next(values: Iterator[bytes]) -> bytes:
    try:
        return next(values)
    except StopIteration:
        raise ArchiveError("too few values") from None


def lines_out(lines: list[bytes], trailing: bool) -> bytes:
    return b"\n".join(lines) + (b"\n" if trailing else b"")


def decimal_text(value: int, scale: int) -> bytes:
    """Fixed-point text; the point is always printed."""
    sign, digits = ("-" if value < 0 else ""), str(abs(value)).rjust(scale + 1, "0")
    return f"{sign}{digits[: len(digits) - scale]}.{digits[len(digits) - scale :]}".encode()


def _sums(c: Cursor) -> Iterator[int]:
    """Running sums of zigzag deltas, wrapping at 64 bits."""
    total = 0
    while not c.done():
        total = (total + c.sv() + (1 << 63)) % (1 << 64) - (1 << 63)
        yield total


def bit(data: bytes, i: int) -> int:
    if i >> 3 >= len(data):
        raise ArchiveError("bitmap is cut short")
    return data[i >> 3] >> (i & 7) & 1


# ---------------------------------------------------------------- columns of the tabular codec


def _column(kind: int, data: bytes, earlier: list[list[bytes]]) -> list[bytes]:
    c = Cursor(data)
    if kind == 0:
        return cells(data)
    if kind == 1:
        return [b"%d" % v for v in _sums(c)]
    if kind == 2:
        scale = c.byte()
        if scale > 18:
            raise ArchiveError("scale over 18")
        return [decimal_text(v, scale) for v in _sums(c)]
    if kind == 3:
        sub = c.byte()
        scale = c.byte() if sub == 1 else 0
        n = c.uv()
        mask = c.take((n + 7) // 8)
        odd = [c.lp() for _ in range(min(c.uv(), n))]
        show = (lambda v: b"%d" % v) if sub == 0 else (lambda v: decimal_text(v, scale))
        numbers, others = map(show, _sums(c)), iter(odd)
        return [_next(numbers if bit(mask, i) else others) for i in range(n)]
    if kind == 4:
        source, n = c.uv(), c.uv()
        if source >= len(earlier):
            raise ArchiveError("derived from a later column")
        named = [c.lp() for _ in range(min(n, len(data) + 1))]
        rank: dict[bytes, int] = {}
        out = []
        for v in earlier[source]:
            i = rank.setdefault(v, len(rank))
            if i >= len(named):
                raise ArchiveError("derived value is missing")
            out.append(named[i])
        return out
    if kind == 5:
        n, size = c.uv(), c.uv()
        words = [c.lp() for _ in range(min(size, len(data) + 1))]
        picks = [c.uv() for _ in range(min(n, len(data) + 1))]
        if any(p >= len(words) for p in picks):
            raise ArchiveError("no such dictionary entry")
        return [words[p] for p in picks]
    if kind == 6:
        n, least, width = c.uv(), c.sv(), c.byte()
        if not 1 <= width <= 8:
            raise ArchiveError("bad width")
        planes = np.frombuffer(c.take(n * width), np.uint8).reshape(width, n)
        value = sum((planes[i].astype(object) << (8 * i) for i in range(width)), np.zeros(n, object))
        return [b"%d" % ((int(v) + least + (1 << 63)) % (1 << 64) - (1 << 63)) for v in value]
    return []


def columnar(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    rows, trailing, has_header, delim, ncols = c.uv(), c.byte(), c.byte(), c.lp(), c.uv()
    sizes, kinds, modes = Cursor(s.get("col_index", b"")), Cursor(s.get("coltypes", b"")), Cursor(s.get("quotemodes", b""))
    values, columns = Cursor(s.get("values", b"")), []
    for _ in range(ncols):
        columns.append(_column(kinds.byte(), values.take(sizes.uv()), columns))
    bits, quoted = Cursor(s.get("quotebits", b"")), []
    for col in columns:
        mode = modes.byte()
        quoted.append(bits.take((len(col) + 7) // 8) if mode == 2 else mode == 1)
    row_modes, counts, verbatim = Cursor(s.get("row_modes", b"")), Cursor(s.get("fieldcounts", b"")), iter(cells(s.get("verbatim", b"")))
    place, out = [0] * ncols, [s.get("header", b"")] if has_header else []
    for _ in range(rows):
        if not row_modes.byte():
            out.append(next(verbatim, b""))
            continue
        fields = []
        n = counts.uv()
        if n > ncols:
            raise ArchiveError("more fields than columns")
        for i in range(n):
            if place[i] >= len(columns[i]):
                raise ArchiveError("field index over the end")
            v, q = columns[i][place[i]], quoted[i]
            if bit(q, place[i]) if isinstance(q, bytes) else q:
                v = b'"' + v.replace(b'"', b'""') + b'"'
            fields.append(v)
            place[i] += 1
        out.append(delim.join(fields))
    return lines_out(out, bool(trailing))


# ---------------------------------------------------------------- log templates


def _fill(template: bytes, hole: bytes, values: Iterator[bytes], missing: bytes | None = None) -> bytes:
    parts = template.split(hole)
    out = [parts[0]]
    for p in parts[1:]:
        out += [_next(values) if missing is None else next(values, missing), p]
    return b"".join(out)


def log(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    n, trailing = c.uv(), c.byte()
    templates, flags, ids = cells(s.get("templates", b"")), Cursor(s.get("flags", b"")), Cursor(s.get("tids", b""))
    values, verbatim, out = iter(cells(s.get("vars", b""))), iter(cells(s.get("verbatim", b""))), []
    for _ in range(n):
        if flags.byte():
            out.append(_fill(_at(templates, ids.uv()), b"\0", values))
        else:
            out.append(_next(verbatim))
    return lines_out(out, bool(trailing))


def _at(items: list, i: int):
    if i >= len(items):
        raise ArchiveError("index over the end")
    return items[i]


def ssh(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    n, trailing = c.uv(), c.byte()
    flags, ids, pids = Cursor(s.get("flags", b"")), Cursor(s.get("template_ids", b"")), Cursor(s.get("pids", b""))
    templates = cells(s.get("templates", b""))
    month, day, time, host, given, rawmsgs, verbatim = (iter(cells(s.get(k, b""))) for k in ("months", "days", "times", "hosts", "vars", "rawmsgs", "verbatim"))
    out = []
    for _ in range(n):
        flag = flags.byte()
        if not flag:
            out.append(_next(verbatim))
            continue
        head = b" ".join(map(_next, (month, day, time, host)))
        pid = pids.uv()
        if flag == 2:
            template = _at(templates, ids.uv())
            text = _fill(template, b"<*>", iter(_next(given).split(b"\0")), b"")
        else:
            text = _next(rawmsgs)
        out.append(b"%s sshd[%d]: %s" % (head, pid, text))
    return lines_out(out, bool(trailing))


# ---------------------------------------------------------------- JSON


def _value_columns(s: Streams, gap: int) -> list[bytes]:
    c, v = Cursor(s.get("value_index", b"")), Cursor(s.get("values", b""))
    n, out = c.uv(), []
    for i in range(n):
        if i and gap:
            v.take(gap)
        out.append(v.take(c.uv()))
    return out


def _vocabulary(data: bytes) -> list[bytes]:
    c = Cursor(data)
    n = c.uv() if data else 0
    found = c.data[c.at :].split(b"\0")
    if n >= len(found) + (n == 0):
        raise ArchiveError("vocabulary is cut short")
    return found[:n]


def _unquote(v: bytes) -> bytes:
    return v[1:-1] if len(v) >= 2 and v[:1] == b'"' else v


def json_lines(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    n, trailing = c.uv(), c.byte()
    flags, tape, keys = Cursor(s.get("flags", b"")), Cursor(s.get("tape", b"")), cells(s.get("keyvocab", b""))
    columns = [iter(cells(v)) for v in _value_columns(s, 1)]
    verbatim, last, rules = iter(cells(s.get("verbatim", b""))), [b""] * len(columns), []
    if r := s.get("rules", b""):
        rc = Cursor(r)
        for _ in range(rc.uv()):
            literals = [rc.lp() for _ in range(rc.uv())]
            sources = [rc.uv() for _ in range(rc.uv())]
            if len(literals) != len(sources) + 1:
                raise ArchiveError("rule without its literals")
            rules.append((literals, sources))

    def leaf(token: int) -> bytes:
        if token == 0:
            i = tape.uv()
            v = _next(_at(columns, i))
            last[i] = _unquote(v)
            return v
        if token == 3:
            literals, sources = _at(rules, tape.uv())
            return b'"' + b"".join(itertools.chain.from_iterable(zip(literals, [*(_at(last, i) for i in sources), b""], strict=True))) + b'"'
        raise ArchiveError("unknown token")

    def node() -> bytes:
        """One value; open objects and lists are held on a stack of (closing sign, members left, is an object)."""
        text: list[bytes] = []
        held: list[list] = []
        while True:
            token = tape.uv()
            if token in (1, 2):
                text.append(b"{" if token == 1 else b"[")
                held.append([b"}" if token == 1 else b"]", tape.uv(), token == 1, True])
                if len(held) > DEPTH:
                    raise ArchiveError("too deep")
            else:
                if len(held) >= DEPTH:
                    raise ArchiveError("too deep")
                text.append(leaf(token))
            while held and not held[-1][1]:
                text.append(held.pop()[0])
            if not held:
                return b"".join(text)
            top = held[-1]
            top[1] -= 1
            if not top[3]:
                text.append(b",")
            top[3] = False
            if top[2]:
                text.append(_at(keys, tape.uv()) + b":")

    out = [node() if flags.byte() else _next(verbatim) for _ in range(n)]
    return lines_out(out, trailing == 1)


def json_document(s: Streams) -> bytes:
    if Cursor(s.get("meta", b"")).byte() == 0:
        return s.get("raw", b"")
    ids, columns = Cursor(s.get("colids", b"")), [iter(cells(v)) for v in _value_columns(s, 0)]
    parts = s.get("skeleton", b"").split(b"\0")
    return parts[0] + b"".join([_next(_at(columns, ids.uv())) + p for p in parts[1:]])


# ---------------------------------------------------------------- map data


def coordinate(v: int) -> bytes:
    """Ten-millionths of a degree as the shortest text."""
    return decimal_text(v, 7).rstrip(b"0").rstrip(b".")


def epoch_text(v: int) -> bytes:
    try:
        return (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=v)).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0").encode()
    except OverflowError:
        raise ArchiveError("time out of range") from None


def osm(s: Streams) -> bytes:
    trailing = Cursor(s.get("meta", b"")).byte() == 1
    keys, roles, verbatim = _vocabulary(s.get("tag_keys", b"")), _vocabulary(s.get("roles", b"")), Cursor(s.get("verbatim", b""))
    cursors: dict[str, Cursor] = {}
    totals: dict[str, int] = {}

    def cur(name: str) -> Cursor:
        return cursors.setdefault(name, Cursor(s.get(name, b"")))

    def total(name: str) -> int:
        totals[name] = totals.get(name, 0) + cur(name).sv()
        return totals[name]

    out = []
    for op in s.get("opcodes", b""):
        if op == 0:
            out.append(verbatim.lp())
            continue
        p, tag = {1: ("n_", b"node"), 2: ("w_", b"way")}.get(op, ("r_", b"relation"))
        head = b'  <%s id="%d" version="%d" timestamp="%s"' % (tag, total(p + "id"), cur(p + "ver").uv(), epoch_text(total(p + "ts")))
        inner = []
        if op == 1:
            head += b' lat="%s" lon="%s"' % (coordinate(total("n_lat")), coordinate(total("n_lon")))
        elif op == 2:
            inner = [b'    <nd ref="%d"/>' % total("w_ndref") for _ in range(cur("w_ndcnt").uv())]
        else:
            for _ in range(cur("r_memcnt").uv()):
                kind = _at([b"node", b"way", b"relation"], cur("r_memtype").uv())
                inner.append(b'    <member type="%s" ref="%d" role="%s"/>' % (kind, total("r_memref"), _at(roles, cur("r_memrole").uv())))
        for _ in range(cur(p + "tagcnt").uv()):
            inner.append(b'    <tag k="%s" v="%s"/>' % (_at(keys, cur(p + "tagkey").uv()), cur(p + "tagval").lp()))
        out += [head + b">", *inner, b"  </%s>" % tag] if inner else [head + b"/>"]
    return lines_out(out, trailing)


# ---------------------------------------------------------------- genotypes


def vcf(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    n, trailing, samples, delta = c.uv(), c.byte(), c.uv(), c.byte()
    ref, vocabulary = c.lp(), [c.lp() for _ in range(c.uv())]
    flags, gt, verbatim = Cursor(s.get("flags", b"")), Cursor(s.get("gt", b"")), iter(cells(s.get("verbatim", b"")))
    names = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")
    fields = [(b"%d" % v for v in _sums(Cursor(s.get(k, b"")))) if k == "pos" and delta else iter(cells(s.get(k, b""))) for k in names]
    out = []
    for _ in range(n):
        if not flags.byte():
            out.append(_next(verbatim))
            continue
        line, at, listed = [_next(f) for f in fields], 0, {}
        for _ in range(gt.uv()):
            at += gt.uv()
            listed[at] = _at(vocabulary, gt.uv())
        if listed and max(listed) >= samples:
            raise ArchiveError("no such sample")
        out.append(b"\t".join(line) + b"\t" + b"\t".join(listed.get(i, ref) for i in range(samples)))
    return lines_out(out, bool(trailing))


# ---------------------------------------------------------------- row groups


class Groups:
    """Layout of the queryable codecs: meta, and where the blocks of each group are."""

    def __init__(self, streams: Callable[[str], bytes], codec: int) -> None:
        c = Cursor(streams("meta"))
        self.lines, self.trailing = c.uv(), bool(c.byte())
        self.delim = c.lp() if codec == 7 else b""
        self.ncols, self.rows, self.n_struct, self.count = c.uv(), c.uv(), c.uv(), c.uv()
        self.kinds = c.take(self.ncols)
        self.template: list[bytes] = []
        if codec == 8:
            t = Cursor(streams("template"))
            self.template = [t.lp() for _ in range(t.uv())]
            if len(self.template) != self.ncols + 1:
                raise ArchiveError("template does not fit the columns")
        index, at = Cursor(streams("index")), 0
        #: (offset, size, statistics) by group and column
        self.blocks: list[list[tuple[int, int, tuple | None]]] = []
        if self.count and not self.rows or self.count > len(index.data) + 1:
            raise ArchiveError("bad row groups")
        for _ in range(self.count):
            group = []
            for kind in self.kinds:
                size = index.uv()
                stats = (index.sv(), index.sv()) if kind == 1 else tuple(np.frombuffer(index.take(16), "<f8").tolist()) if kind == 2 else None
                group.append((at, size, stats))
                at += size
            self.blocks.append(group)


def block_cells(block: bytes) -> list[bytes]:
    if not block:
        raise ArchiveError("empty block")
    # Inside blocks there is no stored form: what is not zstd is xz.
    return cells(wire.expand(block[0] if block[0] == wire.ZSTD else wire.XZ, block[1:]))


def _grouped(s: Streams, codec: int) -> list[bytes]:
    g = Groups(lambda n: s.get(n, b""), codec)
    blocks, modes, verbatim = s.get("blocks", b""), Cursor(s.get("row_modes", b"")), iter(cells(s.get("verbatim", b"")))

    def rows() -> Iterator[bytes]:
        for group in g.blocks:
            for at, size, _ in group:
                if at + size > len(blocks):
                    raise ArchiveError("block over the end")
            columns = [block_cells(blocks[at : at + size]) for at, size, _ in group]
            for values in zip(*columns, strict=False):
                if codec == 7:
                    yield g.delim.join(values)
                else:
                    yield g.template[0] + b"".join([v + t for v, t in zip(values, g.template[1:], strict=True)])

    structured = rows()
    return [_next(structured) if modes.byte() else _next(verbatim) for _ in range(g.lines)]


def qcolumnar(s: Streams) -> bytes:
    return lines_out(_grouped(s, 7), bool(_trailing(s)))


def qjson(s: Streams) -> bytes:
    return lines_out(_grouped(s, 8), bool(_trailing(s)))


def _trailing(s: Streams) -> int:
    c = Cursor(s.get("meta", b""))
    c.uv()
    return c.byte()


def qjson_many(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    n, trailing, kinds = c.uv(), c.byte(), c.uv()
    if kinds > 64:
        raise ArchiveError("too many templates")
    sources = [iter(_grouped({k.split(":", 1)[1]: v for k, v in s.items() if k.startswith(f"t{i}:")}, 8)) for i in range(kinds)]
    which, verbatim = Cursor(s.get("line_map", b"")), iter(cells(s.get("verbatim", b"")))
    out = []
    for _ in range(n):
        k = which.uv()
        out.append(_next(_at(sources, k - 1)) if k else _next(verbatim))
    return lines_out(out, bool(trailing and n))


# ---------------------------------------------------------------- arrays


def dicom(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    if c.byte() == 0:
        return s.get("raw", b"")
    transform, kind, rows, cols, samples, bits = c.byte(), c.byte(), c.uv(), c.uv(), c.uv(), c.uv()
    padding, pix = c.lp(), s.get("pix", b"")
    if kind:
        raise ArchiveError("pixels of another class")
    width = 1 if bits == 8 else 2
    if transform > 3:
        raise ArchiveError("unknown transform")
    if transform:
        if len(pix) != rows * cols * samples * width:
            raise ArchiveError("pixels do not fit the shape")
        if transform == 3:
            n = len(pix) // 2
            pix = np.stack([np.frombuffer(pix[n : 2 * n], np.uint8), np.frombuffer(pix[:n], np.uint8)], axis=1).tobytes()
        else:
            if not cols * samples:
                raise ArchiveError("no width")
            kind_ = np.uint8 if width == 1 else np.dtype("<u2")
            grid = np.frombuffer(pix, kind_).reshape(rows, cols, samples)
            pix = np.cumsum(grid, axis=1 if transform == 1 else 0, dtype=np.uint64).astype(kind_).tobytes()
    return s.get("pre", b"") + pix + padding + s.get("suf", b"")


def embed(s: Streams) -> bytes:
    c = Cursor(s.get("meta", b""))
    width, header, n = c.uv(), c.lp(), c.uv()
    data = s.get("data", b"")
    if not 1 <= width <= 32 or len(data) < n * width:
        raise ArchiveError("tensor does not fit its shape")
    return header + np.frombuffer(data[: n * width], np.uint8).reshape(width, n).T.tobytes()


CODECS: dict[int, Callable[[Streams], bytes]] = {0: ssh, 1: json_lines, 2: osm, 3: log, 4: columnar, 5: vcf, 6: json_document, 7: qcolumnar, 8: qjson, 9: dicom, 10: embed, 11: qjson_many}
BUNDLE = 12


def decode_body(codec: int, is_raw: bool, body: bytes, ceiling: int = wire.DEFAULT_CEILING) -> bytes:
    if is_raw:
        return wire.open_raw(body, ceiling)
    if codec not in CODECS:
        raise ArchiveError(f"codec {codec} is not decoded alone")
    try:
        return CODECS[codec](wire.unpack(body, ceiling))
    except (RecursionError, MemoryError, OverflowError) as e:
        raise ArchiveError(str(e)) from e


def decode(blob: bytes | None, ceiling: int = wire.DEFAULT_CEILING) -> bytes:
    """The original bytes of a container; a hash trailer is verified."""
    box = wire.parse(blob)
    out = b"".join([decode_body(box.codec, r, b, ceiling) for r, b in box.bodies])
    if box.sha256 is not None and hashlib.sha256(out).digest() != box.sha256:
        raise ArchiveError("hash differs")
    return out


_UNSAFE = re.compile(r"^$|^/|\\|:|(^|/)(\.\.)?(/|$)")


def safe_name(name: str) -> bool:
    """Whether a bundle entry's name stays inside the folder it is extracted to."""
    return not _UNSAFE.search(name)


def bundle_entries(blob: bytes) -> Iterator[tuple[str, bytes]]:
    """Names and containers of a bundle, up to the first empty entry."""
    box = wire.parse(blob)
    if box.codec != BUNDLE or box.kind != wire.WHOLE:
        raise ArchiveError("not a bundle")
    s = wire.unpack(box.bodies[0][1])
    try:
        manifest = json.loads(s.get("manifest", b"[]"))
        names = [e["name"] for e in (manifest["entries"] if isinstance(manifest, dict) else manifest)]
    except (ValueError, KeyError, TypeError) as e:
        raise ArchiveError("bad manifest") from e
    for i, name in enumerate(names):
        body = s.get(f"e{i}", b"")
        if not body:
            return
        if not safe_name(name):
            raise ArchiveError("unsafe entry name")
        yield name, body
