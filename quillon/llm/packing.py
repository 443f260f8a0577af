"""Sequence packing by lexical retrieval.

Texts are tokenised by a public tokenizer and end in an end token.  What fills whole windows of
a document is cut off first; the rest of each document goes into a pool.  The pool is dealt into
shards of bounded size, by the leading term of each rest (that of the greatest weight), so that rests
about the same thing meet.  Each shard has a BM25 inverted index over token ids, with document frequencies and mean
length of the whole table.  A seed fetches its best unused neighbours from the index; they fill
its window greedily, and what does not fit is cut and stays in the index.  So only the last window
of a shard is padded, and none whose length is a power of two.

A null or empty text has the end token alone.  Repeated rows are packed each for itself; a null
doc_id is kept.  Extra columns are ignored; an empty table gives an empty result.
Rests are dealt by a hash of their leading term; a term that leads many is dealt to several places.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import estimated_bytes, slices, table, tidy, written

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
WINDOW = 2048
END = 1
#: Rests in one shard at most.
SHARD = 1024
#: Rests of one leading term that are dealt to one place, about.
LEAD_RESTS = 8 * SHARD
K1, B = 1.2, 0.75


#: A word of letters, perhaps with other signs before and behind it.  The tokenizer splits letters from
#: other signs, so these are up to three parts.  An apostrophe before letters is not among them, since
#: it may belong to a contraction.  The letters are those whose lower case is one letter.
_SHAPE = r"^(?P<before>[!-&(-/:-@\[-`{-~]*)(?P<letters>[a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+)(?P<behind>[!-/:-@\[-`{-~]*)$"


def _bytes(column: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_numpy(zero_copy_only=False).tolist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1, ... of each of many runs, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _byte_signs() -> dict[int, str]:
    """The signs by which the tokenizer's vocabulary writes the bytes from 128 on, by byte."""
    hidden = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
    return {b: chr(256 + i) for i, b in enumerate(hidden) if b >= 128}


class TokenIds(dict):
    """Parts of words (bytes) to their ids as little-endian uint16.

    The tokenizer splits at white space and treats every word for itself, so the ids of a text
    are those of its words.  A part of letters or of other signs alone is never split before its pairs are
    merged, so the tokenizer's model is asked for it directly.  Emptied when it grows too large (the
    limit keeps it at some 20 MB) and at the end of each task.
    """

    LIMIT = 100_000
    SIGNS = _byte_signs()

    def __init__(self, name: str) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.code = [i.to_bytes(2, "little") for i in range(VOCABULARY)]

    def _encode(self, words: list[bytes]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast([w.decode(errors="replace") for w in words], add_special_tokens=False):
            yield np.array(e.ids, "<u2").tobytes()

    def _encode_parts(self, parts: list[bytes]) -> Iterator[bytes]:
        code, model = self.code, self.model
        for text in b" ".join(parts).decode().lower().encode().decode("latin-1").translate(self.SIGNS).split(" "):
            yield b"".join([code[t.id] for t in model.tokenize(text)])

    def of_parts(self, parts: list[bytes], whole: set[bytes]) -> list[bytes]:
        """The ids of each part; those in ``whole`` are given to the tokenizer as texts."""
        ids = list(map(self.get, parts))
        new = [i for i, x in enumerate(ids) if x is None]
        kinds: tuple[list[int], ...] = ([], [], [])
        for i in new:
            kinds[0 if parts[i] in whole else 1 if parts[i].isascii() else 2].append(i)
        for some, encode in zip(kinds, (self._encode, self._encode_parts, self._encode_parts), strict=True):
            if some:
                for i, x in zip(some, encode([parts[i] for i in some]), strict=True):
                    ids[i] = x
        if len(self) + len(new) > self.LIMIT:
            self.clear()
        self.update((parts[i], ids[i]) for i in new[: self.LIMIT])
        return ids

    def of_words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, as bytes."""
        found = pc.extract_regex(words, _SHAPE)
        plain = pc.and_(pc.is_valid(found), pc.invert(pc.match_substring(words, "<|")))
        named = [pc.if_else(plain, pc.struct_field(found, i), x) for i, x in enumerate(("", words, ""))]
        parts = pa.concat_arrays(named).dictionary_encode()
        ids = self.of_parts(_bytes(parts.dictionary), set(_bytes(words.filter(pc.invert(plain)))))
        ids = pa.array(ids, pa.large_binary()).take(parts.indices)
        return pc.binary_join_element_wise(*(ids.slice(i * len(words), len(words)) for i in range(3)), pa.scalar(b"", pa.large_binary()))


_known: dict[str, TokenIds] = {}


def tokenizer(name: str = TOKENIZER) -> TokenIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if name not in _known:
        _known[name] = TokenIds(name)
    return _known[name]


def ids_of(texts: pa.Array, name: str = TOKENIZER) -> list[np.ndarray]:
    """Token ids (uint16) of each text of an Arrow string column, end token included."""
    known = tokenizer(name)
    texts = pc.fill_null(texts, "")
    # The tokenizer lower-cases as well; its special tokens alone are matched before that.
    words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
    coded = words.flatten().dictionary_encode()
    ids = known.of_words(coded.dictionary).take(coded.indices)
    places = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1] // 2 if len(ids) else np.zeros(1, np.int64)
    flat = np.frombuffer(ids.buffers()[2] or b"", "<u2")
    ends = places[words.offsets.to_numpy() - words.offsets[0].as_py()]
    return [np.append(flat[a:b], np.uint16(END)) for a, b in itertools.pairwise(ends.tolist())]


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECE_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECE = pa.schema([(c.split()[0], pa.int64()) for c in _PIECE_SQL.split(", ")])


def _cut(name: str):
    """Whole windows as finished pieces; the rest with its ids.  Behind them, for each task, the number of
    rests that hold each token; token -1 has the number of rests, -2 their tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        count, docs, tokens = np.zeros(VOCABULARY, np.int64), 0, 0
        for batch in slices(batches, 2048):
            rows, rests, held = [], [], [np.zeros(0, np.uint16)]
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of(batch.column(1), name), strict=True):
                whole = len(ids) // WINDOW * WINDOW
                for start in range(0, whole, WINDOW):
                    rows.append((doc, start, WINDOW, crc_of(ids[start : start + WINDOW]), len(ids), number, 0))
                    rests.append(None)
                    number += 1
                if whole < len(ids):
                    rows.append((doc, whole, len(ids) - whole, None, len(ids), None, None))
                    rests.append(ids[whole:].tobytes())
                    held.append(np.unique(ids[whole:]))
                    tokens += len(ids) - whole
            count += np.bincount(np.concatenate(held), minlength=VOCABULARY)
            docs += len(held) - 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            nulls = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(rests, pa.binary()), nulls, nulls], names=[*_PIECE.names, "rest", "token", "n"])
        seen = np.flatnonzero(count)
        nulls = [pa.nulls(len(seen) + 2, t) for t in [*_PIECE.types, pa.binary()]]
        yield pa.RecordBatch.from_arrays([*nulls, pa.array(np.append(seen, [-1, -2])), pa.array(np.append(count[seen], [docs, tokens]))], names=[*_PIECE.names, "rest", "token", "n"])

    return lambda batches: tidy(cut(batches), tokenizer(name))


class Bm25:
    """Statistics of the whole table: one weight for each token of the vocabulary."""

    def __init__(self, count: dict[int, int]) -> None:
        self.docs, tokens = count.get(-1, 0), count.get(-2, 0)
        df = np.zeros(VOCABULARY)
        for t, n in count.items():
            if t >= 0:
                df[t] = n
        self.df = df
        self.idf = np.log1p((self.docs - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.mean = max(1.0, tokens / max(1, self.docs))

    def weights(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct tokens of a rest and their BM25 weights."""
        terms, tf = np.unique(ids, return_counts=True)
        terms = terms.astype(np.int64)
        return terms, self.idf[terms] * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / self.mean)))


def _route(stats: Bm25):
    """Add the leading term of each rest, and a salt if many rests have that term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, salt = [], []
            for doc, start, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True):
                terms, weight = stats.weights(np.frombuffer(raw, "<u2"))
                lead.append(int(terms[np.argmax(weight)]))
                salt.append(zlib.crc32(repr((doc, start)).encode() + raw) % int(1 + stats.df[lead[-1]] // LEAD_RESTS))
            yield pa.RecordBatch.from_arrays([pa.array(lead, pa.int32()), pa.array(salt, pa.int32()), *batch.columns], names=["lead", "salt", *batch.schema.names])

    return run


def pack_shard(rests: list[np.ndarray], stats: Bm25) -> list[list[tuple[int, int, int]]]:
    """Windows of (rest, first token, tokens).  Each token is in exactly one.

    A seed's neighbours are scored by all its distinct terms.
    """
    n = len(rests)
    found = [stats.weights(r) for r in rests]
    term = np.concatenate([t for t, _ in found]) if n else np.zeros(0, int)
    doc = np.repeat(np.arange(n), [len(t) for t, _ in found])
    weight = np.concatenate([w for _, w in found]) if n else np.zeros(0)
    order = np.argsort(term, kind="stable")
    doc, weight = doc[order], weight[order]
    first = np.append(0, np.cumsum(np.bincount(term, minlength=VOCABULARY)))
    done, size, unused = np.zeros(n, np.int64), np.array([len(r) for r in rests], np.int64), np.ones(n, bool)
    windows, seed, indexed = [], 0, n
    while True:
        while seed < n and not unused[seed]:
            seed += 1
        if seed == n:
            return windows
        left = int(unused.sum())
        if left <= 0.8 * indexed:
            # Used rests leave the index.
            live, indexed = unused[doc], left
            doc, weight, first = doc[live], weight[live], np.append(0, np.cumsum(live))[first]
        window, space = [], WINDOW

        def take(i: int) -> None:
            nonlocal space
            m = int(min(space, size[i] - done[i]))
            window.append((i, int(done[i]), m))
            done[i] += m
            space -= m
            unused[i] = done[i] < size[i]

        take(seed)
        if space:
            terms, _ = found[seed]
            at = ragged(first[terms], first[terms + 1] - first[terms])
            score = np.bincount(doc[at], weight[at], n)
            near = np.flatnonzero((score > 0) & unused)
            for i in near[np.argsort(-score[near], kind="stable")]:
                if not space:
                    break
                take(int(i))
            # Without more neighbours the following rests, of the same leading term, come next.
            i = seed + 1
            while space and i < n:
                if unused[i]:
                    take(i)
                i += 1
        windows.append(window)


def _pack(stats: Bm25):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = (1 << 62) + (TaskContext.get().partitionId() << 36)
        held: list[tuple] = []

        def close(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            rests = [np.frombuffer(r[4], "<u2") for r in rows]
            out = []
            for window in pack_shard(rests, stats):
                offset = 0
                for i, at, m in window:
                    doc, start, _, total, _ = rows[i]
                    out.append((doc, start + at, m, crc_of(rests[i][at : at + m]), total, number, offset))
                    offset += m
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=_PIECE)

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= SHARD:
                yield close(held[:SHARD])
                held = held[SHARD:]
        if held:
            yield close(held)

    return run


def pack(docs: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """Pieces of every document and their places in sequences of at most 2048 tokens."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = written(texts.mapInArrow(_cut(name), _PIECE_SQL + ", rest binary, token long, n long"), "cut")
    rests = cut.where("rest is not null").select("doc_id", "start", "length", "doc_tokens", "rest")
    # At most one row for each token of the vocabulary.
    counted = cut.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    stats = Bm25({r["token"]: r["n"] for r in counted.collect()})
    parts = max(1, min(1 << 16, estimated_bytes(rests) // (8 << 20)))
    routed = rests.mapInArrow(_route(stats), "lead int, salt int, doc_id long, start long, length long, doc_tokens long, rest binary")
    order = ["lead", "salt", F.xxhash64("doc_id", "start", "length", "rest"), "doc_id"]
    dealt = routed.repartition(parts, "lead", "salt").sortWithinPartitions(*order)
    packed = dealt.select("doc_id", "start", "length", "doc_tokens", "rest").mapInArrow(_pack(stats), _PIECE_SQL)
    return cut.where("rest is null and token is null").select(*_PIECE.names).unionByName(packed)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


__all__ = ["Bm25", "crc_of", "ids_of", "op6_packing", "pack", "pack_shard"]
