"""Containers: golden bytes, malformed input, round trips."""

from __future__ import annotations

import ast
import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.sources import codecs, encode, wire

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
with open(os.path.join(ROOT, "FIXTURES.md")) as f:
    GOLDEN = {n: (bytes.fromhex(h), ast.literal_eval(e)) for n, h, e in re.findall(r"### (\w+)\n\n```\nhex\s+([0-9a-f]+)\nexpected (b'.*?')\n```", f.read())}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden(name):
    assert codecs.decode(GOLDEN[name][0]) == GOLDEN[name][1]


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_damage_raises_only_our_errors(name):
    blob = GOLDEN[name][0]
    for i in range(len(blob)):
        for bad in [blob[:i], *(blob[:i] + bytes([blob[i] ^ 1 << j]) + blob[i + 1 :] for j in range(8))]:
            try:
                codecs.decode(bad, 1 << 24)
            except wire.ArchiveError:
                pass


@pytest.mark.parametrize("blob", ["4154310207ffff00", "415431020d00", "415431020c00", "4254310200", "415431", "41543102ff", "41543102ff02686f8f434346648f6b96df89dda901c5176b10a6d83961dd3c1ac88b59b2dc327aa4a1533601"])
def test_must_fail(blob):
    with pytest.raises(wire.ArchiveError) as e:
        codecs.decode(bytes.fromhex(blob))
    assert e.value.code == 2


def test_null_and_backend_errors():
    with pytest.raises(wire.ArchiveError):
        codecs.decode(None)
    for backend in (wire.ZSTD, wire.XZ):
        with pytest.raises(wire.BackendError):
            codecs.decode(wire.raw(b"x" * 1000, backend)[:-3])
    with pytest.raises(wire.BackendError):
        codecs.decode(wire.raw(b"x" * 1000), ceiling=10)


@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1)))
def test_varints(values):
    c = wire.Cursor(b"".join(map(wire.put_sv, values)))
    assert [c.sv() for _ in values] == values


CELL = st.one_of(st.text("0123456789.-,\"ab ", max_size=8), st.integers(-(10**18), 10**18).map(str)).map(str.encode)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(CELL, min_size=1, max_size=4), max_size=12), st.booleans(), st.sampled_from([b"a,b", None]))
def test_columnar_round_trip(rows, trailing, header):
    quoted = [[bool(i % 2) for i in range(len(r))] for r in rows]
    want = [b",".join(b'"' + v.replace(b'"', b'""') + b'"' if q else v for v, q in zip(r, f, strict=True)) for r, f in zip(rows, quoted, strict=True)]
    blob = encode.columnar(header, rows, quoted, b",", trailing)
    assert codecs.decode(blob) == b"\n".join(([header] if header else []) + want) + b"\n" * trailing


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300))
def test_best_restores_and_is_never_larger(data):
    blob = encode.best(data)
    assert codecs.decode(blob) == data
    assert len(blob) <= len(wire.raw(data)) + 36


@pytest.mark.parametrize(
    "data",
    [b"", b"\n", b"a,b\n1,2\n3,4\n", b'k,v\n1,"x ""q"""\n2,y', b'{"a":1,"s":"x"}\n{"a":2,"s":"y"}\n', b'{"a": [1, 2, {"b": null}]}', b"job 1 took 20 ms\njob 2 took 7 ms\njob x\n"],
)
def test_text_round_trips(data):
    assert codecs.decode(encode.best(data)) == data
    assert codecs.decode(encode.log(data)) == data
    assert codecs.decode(encode.csv(data)) == data
    assert codecs.decode(encode.json_document(data)) == data


def test_table_seeks_and_bundle_names():
    rng = random.Random(1)
    cols = [[b"%d" % i for i in range(5000)], [b"%.2f" % rng.random() for _ in range(5000)]]
    blob = encode.table(cols, [1, 2], [["a", "bigint"], ["b", "double"]], 1000)
    assert codecs.decode(blob).count(b"\n") == 5000
    box = encode.bundle([("x/y", wire.with_trailer(wire.raw(b"1"), b"1")), ("z", wire.raw(b"2"))])
    assert [(n, codecs.decode(b)) for n, b in codecs.bundle_entries(box)] == [("x/y", b"1"), ("z", b"2")]
    for bad in ("", "/a", "a\\b", "c:", "../a", "a/../b", "a//b", "a/"):
        assert not codecs.safe_name(bad)
    assert codecs.safe_name("a/..b/c")
