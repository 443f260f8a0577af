"""Exact n-gram Jaccard join by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes.  That order is cut into
fragments.  Two sets of sizes a and b that reach the threshold t differ in at most
(a + b)(1 - t)/(1 + t) n-grams, so with one fragment more than that they agree in a whole
fragment: equal (fragment, digest) keys find every pair.  A few fragments more are cut, so that
nearly every set has as many non-empty ones as that argument needs; such a set sends no keys
of empty fragments, which agree among unrelated sets.  (If either set of a pair has enough, one
of its non-empty fragments agrees; if neither has, both send all.)  Candidates are then verified:
the lesser counts of n-grams in fragments bound the overlap from above and drop most; for the
others partial overlaps are counted fragment by fragment and summed per pair; there the order is cut so
that a fragment holds some hundred n-grams, however long a text is.

Documents with equal sets form one node.  Components come first, from links that can change them:
within a key the first node is compared with all others, for each node one pair before the
rest; after the components of these links are known, only keys that still join different
components give more pairs, so no link between nodes of different components is lost.  The nodes of
such a key are compared by size and counts in blocks, and only pairs that may be links become rows: in two
turns the nearest pair of each node in one of its keys, then all pairs of all keys that still lie apart.
Every link lies inside a component, so then the links of each node are counted there, over all pairs
of the component's nodes.  Components are cut into blocks of nodes by hash; a pair of blocks holds its
sets as incidence matrices, whose product is the overlaps, and gives one row for each node.
The comparisons grow with the square of a component, the rows with that divided by a block's size.

Nulls: a null or empty text has no n-gram and links with nothing.  Rows with the same
doc_id are separate rows of the result.  Extra columns are ignored.  An empty table gives an
empty result.  Sets are compared by 64-bit hashes of n-grams and of sets.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _words, as_bytes, drop_written, estimated_bytes, free_name, mix, shingles, slices, small_or_plain, table, tidy, written
from .components import components

#: Most n-grams, about, of a fragment in which partial overlaps are counted.
FRAGMENT_GRAMS = 512
#: Fragments whose counts of n-grams (a byte each, up to 255) bound an overlap.
COUNTS = 128
#: Nodes and n-grams that a block of a component holds, about.
BLOCK_NODES = 1024
BLOCK_GRAMS = 2_000_000

_DOC, _BLOCK, _PAIR = 0, 1, 2
_WIRE = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])
_WIRE_SQL = "part int, kind int, id long, a long, b long, n long, body binary"


class SizeClasses:
    """Intervals of set sizes; a set uses its own class and the next one."""

    def __init__(self, percent: int) -> None:
        self.percent, self.first, self.last = percent, [1], []

    def _extend(self) -> None:
        low = self.first[-1]
        self.last.append(low * 100 // self.percent)
        self.first.append(self.last[-1] + 1)

    def of(self, n: int) -> int:
        while not self.last or self.last[-1] < n:
            self._extend()
        return bisect.bisect_left(self.last, n)

    def fragments(self, tag: int) -> int:
        """One more than the most n-grams in which two sets that use this class can differ."""
        while len(self.last) <= tag:
            self._extend()
        return 2 * self.last[tag] * (100 - self.percent) // (100 + self.percent) + 1

    def cut(self, tag: int) -> int:
        """Fragments that are cut: more than needed by about those that are expected to be empty."""
        need = self.fragments(tag)
        fill = self.percent * (100 + self.percent) / (200 * max(1, 100 - self.percent))
        return need + int(3 * need * math.exp(-fill)) + 1 if need > 1 else 1


def fragment_keys(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """64-bit keys of a set: one for each fragment, for its own size class and the next."""
    own = classes.of(len(grams))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        out = []
        for tag in (own, own + 1):
            k = classes.cut(tag)
            cuts = (np.arange(k + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(k)
            at = np.searchsorted(grams >> np.uint64(32), cuts, side="left")
            at[-1] = len(grams)
            digest = sums[at[1:]] - sums[at[:-1]]
            own_keys = mix(digest + mix(np.arange(k, dtype=np.uint64) + np.uint64(tag << 32)))
            filled = at[1:] > at[:-1]
            out.append(own_keys[filled] if filled.sum() >= classes.fragments(tag) else own_keys)
    return np.concatenate(out)


def counts(grams: np.ndarray) -> bytes:
    """Numbers of n-grams in fixed fragments of the global order; 255 stands for more, too."""
    found = np.bincount((grams >> np.uint64(57)).astype(np.int64), minlength=COUNTS)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def set_id(grams: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes()))))


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by key and node without repeats: what is first of its key, and pairs (first, other)."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    if len(keys):
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
        keys, nodes = keys[new], nodes[new]
    head = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    hub = nodes[head][np.cumsum(head) - 1] if len(keys) else nodes
    other = ~head
    pairs = np.unique(np.stack([hub[other], nodes[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return keys[head], nodes[head], pairs


def _rows(part, kind, ids, a, b, n, body) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((part, kind, ids, a, b, n, body), _WIRE.types)], schema=_WIRE)


def _pair_rows(pairs: np.ndarray, parts: int) -> pa.RecordBatch:
    m = len(pairs)
    where = ((pairs[:, 1] if m else np.zeros(0, np.int64)) % parts).astype(np.int32)
    return _rows(where, np.full(m, _PAIR, np.int32), [None] * m, pairs[:, 0], pairs[:, 1], [None] * m, [None] * m)


def _emit(k: int, percent: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, keys, nodes, held = SizeClasses(percent), [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            head, first, pairs = _stars(np.concatenate(keys), np.concatenate(nodes))
            if len(pairs):
                yield _pair_rows(pairs, parts)
            which = ((head >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(which, kind="stable")
            head, first, which = head[order], first[order], which[order]
            cuts = np.searchsorted(which, np.arange(parts + 1))
            body, at = [], []
            for p in range(parts):
                lo, hi = cuts[p], cuts[p + 1]
                if lo < hi:
                    names, index = np.unique(first[lo:hi], return_inverse=True)
                    low = head[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                    at.append(p)
                    body.append(len(names).to_bytes(4, "little") + (hi - lo).item().to_bytes(4, "little") + names.astype("<i8").tobytes() + index.astype("<u2").tobytes() + low.tobytes())
            m = len(at)
            yield _rows(at, [_BLOCK] * m, [None] * m, [None] * m, [None] * m, [None] * m, body)

        dealt = 0
        for batch in slices(batches):
            ids, node, size, texts, count = batch.column(0).to_pylist(), [], [], batch.column(2).to_pylist(), []
            for text in as_bytes(batch.column(1)):
                grams = shingles(text, k)
                size.append(len(grams))
                node.append(set_id(grams) if len(grams) else None)
                count.append(counts(grams) if len(grams) else None)
                if len(grams):
                    own = fragment_keys(grams, classes)
                    keys.append(own)
                    nodes.append(np.full(len(own), node[-1], np.int64))
                    held += len(own)
            m = len(ids)
            # In turn, whatever their texts and ids: copies and empty texts do not meet in one place.
            yield _rows((np.arange(dealt, dealt + m) % parts).astype(np.int32), [_DOC] * m, ids, node, texts, size, count)
            dealt += m
            if held > 1_000_000 or len(nodes) > 60_000:
                yield from block()
                keys, nodes, held = [], [], 0
        if keys:
            yield from block()

    return run


_OUT_SQL = "kind int, id long, a long, b long, n long, body binary"
_OUT = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])


def _gather(group: pa.Table) -> pa.Table:
    """For one part of the keys: the pairs (first node of a key, another node of it)."""
    keys, nodes = [], []
    kind = group.column("kind").to_numpy()
    plain = group.filter(pa.array(kind != _BLOCK)).select(_OUT.names).cast(_OUT)
    for body in group.filter(pa.array(kind == _BLOCK)).column("body").to_pylist():
        m, n = int.from_bytes(body[:4], "little"), int.from_bytes(body[4:8], "little")
        names = np.frombuffer(body, "<i8", m, 8)
        index = np.frombuffer(body, "<u2", n, 8 + 8 * m)
        low = np.frombuffer(body, np.uint8, 5 * n, 8 + 8 * m + 2 * n).reshape(n, 5)
        full = np.zeros((n, 8), np.uint8)
        full[:, :5] = low
        keys.append(full.view("<u8").reshape(n))
        nodes.append(names[index])
    if not keys:
        return plain
    _, _, pairs = _stars(np.concatenate(keys), np.concatenate(nodes))
    m = len(pairs)
    found = pa.table([pa.array(x, t) for x, t in zip((np.full(m, _PAIR, np.int32), pa.nulls(m, pa.int64()), pairs[:, 0], pairs[:, 1], pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())), _OUT.types)], schema=_OUT)
    return pa.concat_tables([plain, found])


def level(n: int) -> int:
    """The global order is cut into 2^level fragments for pairs whose larger set has ``n`` n-grams."""
    return ((n - 1) // FRAGMENT_GRAMS).bit_length()


def _set_rows(k: int, percent: int):
    """(node, level, frag, grams) of each text, cut at fixed points of the global order.

    A set is cut for its own size and for that of the largest set it may be linked with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            node, levels, frag, grams = [], [], [], []
            for text in as_bytes(batch.column(0)):
                own = shingles(text, k)
                for at in range(level(len(own)), level(len(own) * 100 // percent) + 1) if len(own) else ():
                    name, cuts = set_id(own), np.arange(1, 1 << at, dtype=np.uint64) << np.uint64(64 - at)
                    for i, piece in enumerate(np.split(own, np.searchsorted(own, cuts))):
                        if len(piece):
                            node.append(name)
                            levels.append(at)
                            frag.append(i)
                            grams.append(piece.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(levels, pa.int32()), pa.array(frag, pa.int32()), pa.array(grams, pa.list_(pa.int64()))], names=["node", "level", "frag", "grams"])

    return run


def _key_rows(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in slices(batches, 64):
            for text in as_bytes(batch.column(0)):
                own = shingles(text, k)
                if len(own):
                    keys = fragment_keys(own, classes).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), set_id(own), np.int64)), pa.array(np.full(len(keys), len(own), np.int64))], names=["key", "node", "n"])

    return run


def differ_little(left: np.ndarray, right: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether the counts of pairs of sets let them reach the threshold; ``both`` are the sums of their sizes."""
    apart = np.abs(left.astype(np.int16) - right.astype(np.int16)).sum(axis=1, dtype=np.int64)
    return apart * (100 + percent) <= both * (100 - percent)


def _bounded(percent: int):
    """Of rows (a, b, n_a, n_b, counts_a, counts_b) those whose sets differ little enough by their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COUNTS) for i in (4, 5))
            keep = differ_little(left, right, batch.column(2).to_numpy() + batch.column(3).to_numpy(), percent)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array(keep))

    return run


def late_pairs(percent: int, left: list[tuple], right: list[tuple], nearest: bool = False) -> np.ndarray:
    """Pairs (a, b, n_a, n_b) of a key that may be links between different components.

    Rows are (node, n, component, main component of the key, counts).  Of each pair one is outside the
    main component; pairs are tested in steps of bounded size and only the possible ones are returned, with
    ``nearest`` only one for each left node: that whose counts are the least apart.
    """

    def columns(rows: list[tuple]) -> tuple:
        node, n, component, main = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        return node, n, component, component != main, np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(-1, COUNTS)

    node_b, n_b, component_b, out_b, counts_b = columns(right)
    node_a, n_a, component_a, out_a, counts_a = columns(left)
    found = [np.zeros((0, 4), np.int64)]
    step = max(1, (1 << 20) // len(right))
    for low in range(0, len(left), step):
        x = slice(low, low + step)
        sizes = 100 * np.minimum(n_a[x, None], n_b) >= percent * np.maximum(n_a[x, None], n_b)
        i, j = np.nonzero(sizes & (component_a[x, None] != component_b) & (out_a[x, None] | out_b))
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)] + low, j[at : at + (1 << 16)]
            keep = differ_little(counts_a[p], counts_b[q], n_a[p] + n_b[q], percent)
            p, q = p[keep], q[keep]
            if nearest and len(p):
                apart = np.abs(counts_a[p].astype(np.int16) - counts_b[q].astype(np.int16)).sum(axis=1) / (n_a[p] + n_b[q])
                order = np.lexsort((node_b[q], apart, p))
                p, q = p[order], q[order]
                first = np.concatenate([[True], p[1:] != p[:-1]])
                p, q = p[first], q[first]
            turn = node_a[p] > node_b[q]
            pairs = np.stack([node_a[p], node_b[q], n_a[p], n_b[q]], axis=1)
            pairs[turn] = pairs[turn][:, [1, 0, 3, 2]]
            found.append(pairs)
    return np.unique(np.concatenate(found), axis=0)


def _late(percent: int, nearest: bool):
    """Rows (key, i, j, own, node, n, component, main, counts), sorted by the first three, to possible pairs."""

    def pairs(rows: list[tuple]) -> pa.RecordBatch:
        i, j = rows[0][1], rows[0][2]
        left, right = ([r[4:] for r in rows if r[3] == at] for at in (i, j))
        got = late_pairs(percent, left, right, nearest) if left and right else np.zeros((0, 4), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(got[:, c]) for c in range(4)], names=["a", "b", "n_a", "n_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, 4096):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield pairs(held)
                    held = []
                held.append(row)
        if held:
            yield pairs(held)

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, n_a, n_b) those with 100 * intersection >= percent * union, written.

    The sets are joined to one end and then to the other, each by a job of its own, so that they are not shuffled
    for both at once.
    """
    left = sets.select(F.col("node").alias("a"), "level", "frag", F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), "level", "frag", F.col("grams").alias("grams_b"))
    steps = F.expr(f"(greatest(n_a, n_b) - 1) div {FRAGMENT_GRAMS}")
    cut = pairs.withColumn("level", F.when(steps > 0, F.length(F.bin(steps))).otherwise(0))
    half = written(cut.join(left, ["a", "level"]), "half")
    partial = half.join(right, ["b", "level", "frag"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("part"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("shared"))
    links = written(summed.where(f"100 * shared >= {percent} * (n_a + n_b - shared)").select("a", "b"), "links")
    drop_written(half)
    return links


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # An n-gram of one set alone is in no overlap.
    several = times[gram] > 1
    owner, gram = owner[several], (np.cumsum(times > 1) - 1)[gram[several]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    shared = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, columns):
        at = slice(*np.searchsorted(gram, [low, low + columns]))
        held = np.zeros((len(sets), min(columns, int(gram[-1]) + 1 - low)), np.float32)
        held[owner[at], gram[at] - low] = 1
        shared += (held[: len(left)] @ held[len(left) :].T).astype(np.int64)
    return shared


def _count_links(percent: int):
    """Rows (component, i, j, own, node, copies, grams), sorted by the first three, to (node, links)."""

    def count(rows: list[tuple]) -> pa.RecordBatch:
        i, j = rows[0][1], rows[0][2]
        left = [r for r in rows if r[3] == i]
        right = left if i == j else [r for r in rows if r[3] == j]
        if not left or not right:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], names=["node", "links"])
        a, b = ([np.frombuffer(r[6], "<u8") for r in side] for side in (left, right))
        shared = overlaps(a, b)
        both = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - shared
        linked = 100 * shared >= percent * both
        if i == j:
            np.fill_diagonal(linked, False)
        nodes, links = [r[4] for r in left], linked @ np.array([r[5] for r in right], np.int64)
        if i != j:
            nodes += [r[4] for r in right]
            links = np.concatenate([links, linked.T @ np.array([r[5] for r in left], np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64())], names=["node", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield count(held)
                    held = []
                held.append(row)
        if held:
            yield count(held)

    return run


def _tidied(run):
    """``run`` of a task, behind which the word cache is emptied and memory is given back."""
    return lambda batches: tidy(run(batches), _words)


def _whole_sets(k: int):
    """(node, grams) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [s for s in (shingles(t, k) for t in as_bytes(batch.column(0))) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in found], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())], names=["node", "grams"])

    return run


def ngram_rows(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, count_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(id, node, th, n)`` of each row of ``docs`` and ``(node, component_id)`` of each node, with ``links`` if they are to be counted.

    ``node`` names the set and is null without n-grams, ``th`` is the text's hash; ``component_id`` is the
    least id of the component and null if there is none.
    """
    spark = docs.sparkSession
    parts = parts or max(16, min(1 << 16, estimated_bytes(docs) // (4 << 20)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = texts.withColumn("th", F.xxhash64("text"))
    wire = keyed.mapInArrow(_tidied(_emit(k, percent, parts)), _WIRE_SQL)
    found = written(wire.groupBy("part").applyInArrow(_gather, _OUT_SQL), "fragments")
    rows = found.where(f"kind = {_DOC}").select("id", F.col("a").alias("node"), F.col("b").alias("th"), "n", F.col("body").alias("counts"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least_id"), F.min("n").alias("n"), F.min("th").alias("th"), F.min("counts").alias("counts"), F.count("*").alias("copies"))
    nodes = written(nodes, "nodes")

    def possible(pairs: DataFrame) -> DataFrame:
        known = nodes.select("node", "n", "counts")
        sized = pairs.join(known.toDF("a", "n_a", "counts_a"), "a").join(known.toDF("b", "n_b", "counts_b"), "b")
        sized = sized.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        return written(sized.select("a", "b", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(_bounded(percent), "a long, b long, n_a long, n_b long"), "possible")

    def texts_of(names: DataFrame) -> DataFrame:
        wanted = written(names.distinct().join(nodes.select("node", "th"), "node").select("th"), "wanted")
        return keyed.join(small_or_plain(wanted, 16), "th", "left_semi").dropDuplicates(["th"]).select("text")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))

    def sets_of(pairs: DataFrame) -> DataFrame:
        return written(texts_of(ends(pairs)).mapInArrow(_tidied(_set_rows(k, percent)), "node long, level int, frag int, grams array<long>"), "sets")

    def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs with the components of both ends, where these differ."""
        named = pairs.join(label.toDF("a", "component_a"), "a", "left").join(label.toDF("b", "component_b"), "b", "left")
        named = named.withColumn("component_a", F.coalesce("component_a", "a")).withColumn("component_b", F.coalesce("component_b", "b"))
        return named.where("component_a <> component_b")

    first = written(found.where(f"kind = {_PAIR}").select("a", "b").distinct(), "first")
    pairs = possible(first)
    sets = sets_of(pairs)
    one = pairs.groupBy("b").agg(F.min(F.struct("a", "n_a", "n_b")).alias("p")).select("p.a", "b", "p.n_a", "p.n_b")
    links = verified(one, sets, percent)
    label = components(links)
    rest = written(apart(pairs, label).select("a", "b", "n_a", "n_b").join(one.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    more = verified(rest, sets, percent)
    if more.limit(1).count():
        links = links.union(more)
        label = components(links)
    drop_written(sets)

    # Second round: keys whose nodes are still in different components.  Such a key has a pair of
    # the first round that lies apart, and its nodes are in the components of such pairs.
    parted = written(apart(first, label).select("component_a", "component_b"), "parted")
    open_ = parted.select(F.col("component_a").alias("component")).union(parted.select(F.col("component_b").alias("component"))).distinct()
    grouped = nodes.select("node").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keys = texts_of(grouped.join(open_, "component").select("node")).mapInArrow(_tidied(_key_rows(k, percent)), "key long, node long, n long")
    keys = written(keys, "keys")
    # The pair of a key of two nodes is one of the first round; only keys of more have other pairs.
    several = written(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 2").select("key"), "several")
    shared = written(keys.join(small_or_plain(several, 8), "key"), "shared")
    drop_written(keys)
    keys = shared
    seen = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def late_round(turn: int | None) -> DataFrame:
        """Possible links between components from common keys; with a turn, the nearest from one key of each node."""
        known = keys.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))

        def mixed(rows: DataFrame) -> DataFrame:
            count = rows.groupBy("key", "component").agg(F.count("*").alias("m"))
            return count.groupBy("key").agg(F.max(F.struct("m", "component"))["component"].alias("main"), F.sum("m").alias("m"), F.count("*").alias("kinds")).where("kinds > 1")

        if turn is not None:
            known = known.join(mixed(known).select("key"), "key").groupBy("node", "n", "component").agg(F.min_by("key", F.xxhash64(F.lit(turn), "key")).alias("key"))
        known = written(known, "known")
        # Pairs of a key are tested in blocks of its nodes; only those that pass become rows.
        blocks = F.ceil(F.col("m") / BLOCK_NODES).cast("int")
        rows = known.join(mixed(known).select("key", "main", blocks.alias("blocks")), "key").join(nodes.select("node", "counts"), "node")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "component", "main", "counts")
        rows = rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
        found = written(rows.mapInArrow(_tidied(_late(percent, turn is not None)), "a long, b long, n_a long, n_b long"), "late")
        drop_written(known)
        return written(found.distinct().join(seen, ["a", "b"], "left_anti"), "late")

    # First the nearest pairs, which join most of what hangs together; then all that still lie apart.
    for turn in (0, 1, None):
        late = late_round(turn)
        if late.limit(1).count():
            sets = sets_of(late)
            late = verified(late, sets, percent)
            drop_written(sets)
            if late.limit(1).count():
                links = links.union(late)
                label = components(links)
    drop_written(keys)

    named = nodes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = named.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("m"), F.sum("n").alias("grams"), F.sum("copies").alias("all_copies"))
    named = written(named.select("node", "th", "copies", "component").join(whole, "component"), "named")
    if not count_links:
        return rows, named.select("node", "component_id")

    # Up to two nodes are linked with one another; the nodes of larger components are compared.
    large = named.where("m > 2")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_NODES, F.col("grams") / BLOCK_GRAMS)).cast("int")
    member = large.select("component", "node", "copies", blocks.alias("blocks")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    member = member.join(texts_of(large.select("node")).mapInArrow(_tidied(_whole_sets(k)), "node long, grams binary"), "node")
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = member.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "grams")
    member = member.repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    counted = member.mapInArrow(_tidied(_count_links(percent)), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    few = named.where("m <= 2").select("node", (F.col("all_copies") - F.col("copies")).alias("links"))
    # Rows of the node itself are links, too, but for the row in question.
    degree = named.select("node", "component_id", "copies").join(counted.union(few), "node")
    return rows, degree.select("node", "component_id", (F.col("links") + F.col("copies") - 1).alias("links"))


def ngram_components(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, verified_links)``; one row per row of ``docs``.

    ``verified_links`` is the exact number of other rows that the row links with, rows of an equal set
    among them.
    """
    rows, found = ngram_rows(docs, k, percent, id_col, text_col, parts, count_links=True)
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    links = F.coalesce("links", F.lit(0)).cast("long").alias("verified_links")
    return rows.join(found, "node", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component, links)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return ngram_components(table(spark, sf_dir, "documents"), 3, 90)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: the least (doc_id, hash of the text).

    Rows without an n-gram stay, and rows with a null doc_id, since nothing names them.  Rows are told
    apart by doc_id and text: of repeated rows one stays, rows of one doc_id with unrelated texts all stay.
    """
    rows, component = ngram_rows(docs, k, percent)
    named = rows.where("node is not null and id is not null").join(component, "node")
    head = named.groupBy("component_id").agg(F.min(F.struct("id", "th")).alias("head"))
    named = written(named.join(head, "component_id").groupBy("id", "th").agg(F.min(F.col("head") == F.struct("id", "th")).alias("kept"), F.count("*").alias("m")), "kept")
    inner = {c: free_name(docs.columns, c) for c in ("id", "th")}
    marked = docs.withColumns({inner["id"]: F.col("doc_id").cast("long"), inner["th"]: F.xxhash64(F.col("text").cast("string"))})
    on = list(inner.values())
    left = marked.join(named.where("not kept").select("id", "th").toDF(*on), on, "left_anti")
    again = named.where("kept and m > 1").select("id", "th").toDF(*on)
    if again.limit(1).count():
        left = left.join(again, on, "left_anti").unionByName(left.join(again, on, "left_semi").dropDuplicates(on))
    return left.drop(*on)
