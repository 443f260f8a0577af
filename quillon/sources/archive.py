"""The ``archive`` data source: row groups as partitions, pruned by zone maps; writer; frame stream.

Files are reached through pyarrow's file systems, so paths may be local, ``file:`` or of another
store that pyarrow knows.  For stores that only Spark reads, :func:`read_anywhere` decodes rows of
the ``binaryFile`` source.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from . import codecs, encode, wire

FORMAT = "archive"
GROUP = 8192
#: Bytes of blocks that one Spark partition reads, about.
SPLIT_BYTES = 64 << 20


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if re.match(r"[a-z0-9+.-]+:/", path):
        return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pyarrow.fs.LocalFileSystem(), path


def files(path: str) -> list[str]:
    """Archives under a path, sorted."""
    fs, at = file_system(path)
    info = fs.get_file_info(at)
    if info.type == pyarrow.fs.FileType.File:
        return [path]
    found = [i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(at, recursive=True)) if i.is_file and i.base_name.endswith(".arc")]
    prefix = path[: len(path) - len(at)] if path.endswith(at) else "file://" * path.startswith("file:")
    return sorted(prefix + f for f in found)


class Reader:
    """Reads ranges of one file; the streams' places are found by seeking over their bodies."""

    def __init__(self, path: str) -> None:
        fs, at = file_system(path)
        self.file = fs.open_input_file(at)
        head = self.file.read_at(5, 0)
        if head[:4] != wire.MAGIC + bytes([wire.WHOLE]) or head[4] not in (7, 8):
            raise wire.ArchiveError("not a queryable container")
        self.codec, self.streams = head[4], {}
        at, count = self._uv(5)
        if count > wire.MOST_STREAMS:
            raise wire.ArchiveError("too many streams")
        for _ in range(count):
            at, size = self._uv(at)
            name = self.file.read_at(size, at)[: wire.NAME_BYTES].decode("latin-1")
            backend = self.file.read_at(1, at + size)[0]
            at, length = self._uv(at + size + 1)
            self.streams.setdefault(name, wire.Stream(backend, at, length))
            at += length

    def _uv(self, at: int) -> tuple[int, int]:
        c = wire.Cursor(self.file.read_at(10, at))
        return at + (c.uv(), c.at)[1], wire.Cursor(c.data).uv()

    def stream(self, name: str) -> bytes:
        s = self.streams.get(name)
        return wire.expand(s.backend, self.file.read_at(s.size, s.at)) if s else b""

    def close(self) -> None:
        self.file.close()


@dataclass
class GroupPartition(InputPartition):
    """Row groups of one file: for each, offset and size of the blocks of the wanted columns."""

    path: str
    groups: list


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "double": pa.float64(), "float": pa.float32(),
    "boolean": pa.bool_(), "date": pa.date32(), "string": pa.string(), "timestamp": pa.timestamp("us", "UTC"), "timestamp_ntz": pa.timestamp("us"),
}
#: Types whose blocks have least and greatest values: the numbers of the format's integer and decimal kinds.
_KINDS = {"bigint": 1, "int": 1, "smallint": 1, "tinyint": 1, "double": 2}


def arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of a column, by its Spark name; others are refused, before anything is written."""
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", kind):
        return pa.decimal128(int(m[1]), int(m[2]))
    if kind not in _ARROW:
        raise wire.ArchiveError(f"no cells for the type {kind}")
    return _ARROW[kind]


def to_cells(array: pa.Array) -> list[bytes]:
    """Text cells of a column: backslash and newline escaped, null as ``\\N``."""
    text = pc.cast(array, pa.string())
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        text = pc.replace_substring(pc.replace_substring(text, "\\", "\\\\"), "\n", "\\n")
    return [b"\\N" if v is None else v for v in pc.cast(text, pa.binary()).to_pylist()]


def from_cells(cells: list[bytes], kind: str) -> pa.Array:
    raw = pa.array(cells, pa.binary())
    text = pc.if_else(pc.equal(raw, b"\\N"), pa.scalar(None, pa.string()), raw.cast(pa.string()))
    if kind == "string":
        if pc.any(pc.match_substring(text, "\\")).as_py():
            return pa.array([None if v is None else re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], v) for v in text.to_pylist()], pa.string())
        return text
    return pc.cast(text, arrow_type(kind))


class ArchiveReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema_, self.options, self.filters = schema, options, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep comparisons for pruning; Spark still evaluates every filter."""
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In)) and len(f.attribute) == 1:
                self.filters.append(f)
            yield f

    def _may_match(self, stats: dict[str, tuple]) -> bool:
        for f in self.filters:
            low_high = stats.get(f.attribute[0])
            if low_high is None:
                continue
            low, high = low_high
            values = f.value if isinstance(f, In) else [f.value]
            if any(v != v for v in values):
                continue  # NaN is above all numbers, and equal to itself
            try:
                if isinstance(f, (EqualTo, In)):
                    ok = any(v is not None and low <= v <= high for v in values)
                elif isinstance(f, GreaterThan):
                    # An infinite bound may stand for NaN.
                    ok = high > f.value or high == float("inf")
                elif isinstance(f, GreaterThanOrEqual):
                    ok = high >= f.value
                elif isinstance(f, LessThan):
                    ok = low < f.value
                else:
                    ok = low <= f.value
            except TypeError:
                continue
            if not ok:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        # Groups of a file share a split up to so many bytes of wanted blocks.
        out, held, most = [], 0, int(self.options.get("splitbytes", self.options.get("splitBytes", SPLIT_BYTES)))
        prune = self.options.get("prune", "true") == "true"
        for path in files(self.options["path"]):
            r = Reader(path)
            names = [n for n, _ in json.loads(r.stream(encode.NAMES))] if r.streams.get(encode.NAMES) else []
            groups, blocks = codecs.Groups(r.stream, r.codec), r.streams["blocks"]
            r.close()
            if blocks.backend != wire.STORED or not names:
                raise wire.ArchiveError("not written for ranged reads")
            wanted = [names.index(c) for c in self.schema_.names]
            for group in groups.blocks:
                if prune and not self._may_match({n: b[2] for n, b in zip(names, group, strict=True) if b[2]}):
                    continue
                spans = [(blocks.at + group[i][0], group[i][1]) for i in wanted]
                size = sum(n for _, n in spans)
                if not out or out[-1].path != path or held + size > most:
                    out.append(GroupPartition(path, []))
                    held = 0
                out[-1].groups.append(spans)
                held += size
        return out or [GroupPartition("", [])]

    def read(self, partition: GroupPartition) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            return
        fs, at = file_system(partition.path)
        kinds = [f.dataType.simpleString() for f in self.schema_.fields]
        with fs.open_input_file(at) as f:
            for group in partition.groups:
                arrays = [from_cells(codecs.block_cells(f.read_at(size, offset)), kind) for (offset, size), kind in zip(group, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=self.schema_.names)


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class ArchiveWriter(DataSourceArrowWriter):
    """One verified archive for each task.

    The files of a job have its id in their names.  Its commit removes those of attempts that lost and, on
    overwrite, the files that were there before the job; other jobs' files are never touched.  A job
    without rows leaves an archive without rows where there would be none, so the path has a schema.
    """

    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.schema_, self.options, self.job = schema, options, uuid.uuid4().hex
        for kind in self._kinds():
            arrow_type(kind)
        self.before = [i.base_name for i in self._listed()] if overwrite else []

    def _kinds(self) -> list[str]:
        return [f.dataType.simpleString() for f in self.schema_.fields]

    def _listed(self) -> list:
        fs, at = file_system(self.options["path"])
        if fs.get_file_info(at).type != pyarrow.fs.FileType.Directory:
            return []
        return [i for i in fs.get_file_info(pyarrow.fs.FileSelector(at)) if i.base_name.endswith((".arc", ".arc.tmp"))]

    def _store(self, part: int, columns: list[list[bytes]]) -> str:
        kinds = self._kinds()
        body = encode.table(columns, [_KINDS.get(k, 0) for k in kinds], list(zip(self.schema_.names, kinds, strict=True)), int(self.options.get("group", GROUP)))
        fs, at = file_system(self.options["path"])
        fs.create_dir(at, recursive=True)
        name = f"{at}/part-{part:05d}-{self.job}-{uuid.uuid4().hex}.arc"
        with fs.open_output_stream(name + ".tmp") as f:
            f.write(body)
        fs.move(name + ".tmp", name)
        return name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        columns: list[list[bytes]] = [[] for _ in self.schema_.fields]
        for batch in iterator:
            for col, array in zip(columns, batch.columns, strict=True):
                col += to_cells(array)
        if not columns or not columns[0]:
            return Written("", 0)
        return Written(self._store(TaskContext.get().partitionId(), columns), len(columns[0]))

    def commit(self, messages: list) -> None:
        fs, _ = file_system(self.options["path"])
        kept = {m.path.rsplit("/", 1)[1] for m in messages if m and m.path}
        if not kept and not set(i.base_name for i in self._listed() if i.base_name.endswith(".arc")) - set(self.before):
            kept = {self._store(0, [[] for _ in self.schema_.fields]).rsplit("/", 1)[1]}
        for i in self._listed():
            if i.base_name in self.before or f"-{self.job}-" in i.base_name and i.base_name not in kept:
                fs.delete_file(i.path)

    def abort(self, messages: list) -> None:
        fs, _ = file_system(self.options["path"])
        for i in self._listed():
            if f"-{self.job}-" in i.base_name:
                fs.delete_file(i.path)


@dataclass
class FramePartition(InputPartition):
    path: str
    first: int
    last: int


class FrameStream(DataSourceStreamReader):
    """Frames of one container as micro-batches; the offset is the number of frames."""

    def __init__(self, options: dict) -> None:
        self.path, self.step = options["path"], int(options.get("framesPerBatch", "0"))
        self.at = 0

    def _bodies(self) -> list:
        fs, at = file_system(self.path)
        with fs.open_input_file(at) as f:
            return wire.parse(f.read()).bodies

    def initialOffset(self) -> dict:
        return {"frames": 0}

    def latestOffset(self) -> dict:
        count = len(self._bodies())
        self.at = min(count, self.at + self.step) if self.step else count
        return {"frames": self.at}

    def partitions(self, start: dict, end: dict) -> list:
        self.at = max(self.at, end["frames"])
        return [FramePartition(self.path, i, i + 1) for i in range(start["frames"], end["frames"])]

    def read(self, partition: FramePartition) -> Iterator[tuple]:
        fs, at = file_system(partition.path)
        with fs.open_input_file(at) as f:
            box = wire.parse(f.read())
        for i in range(partition.first, partition.last):
            r, body = box.bodies[i]
            text = codecs.decode_body(box.codec, r, body).decode()
            for line in text.removesuffix("\n").split("\n"):
                yield (i, line)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        if self.options.get("frames") == "true":
            return "frame long, value string"
        found = files(self.options["path"])
        if not found:
            raise wire.ArchiveError("no archive under the path")
        r = Reader(found[0])
        names = json.loads(r.stream(encode.NAMES) or b"[]")
        r.close()
        wanted = [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else [n for n, _ in names]
        kinds = dict(names)
        return ", ".join(f"`{n}` {kinds[n]}" for n in wanted)

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(schema, dict(self.options), overwrite)

    def streamReader(self, schema: StructType) -> FrameStream:
        return FrameStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("archive")`` known, with filter pushdown."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def decode_column(df: DataFrame, content: str = "content", ceiling: int = wire.DEFAULT_CEILING, mode: str = "FAILFAST") -> DataFrame:
    """Add ``decoded`` (the original bytes) and ``stats`` to rows of containers.

    Modes: FAILFAST raises, PERMISSIVE gives null, DROPMALFORMED drops the row.
    """
    fields = df.schema
    place = df.columns.index(content)
    out = StructType([*fields.fields, *StructType.fromDDL("decoded binary, stats struct<original:bigint,compressed:bigint,io:bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                blob = row.column(place).to_pylist()[0]
                try:
                    data = codecs.decode(blob, ceiling)
                except wire.ArchiveError:
                    if mode == "FAILFAST":
                        raise
                    if mode == "DROPMALFORMED":
                        continue
                    data = None
                stats = None if data is None else {"original": len(data), "compressed": len(blob), "io": len(blob)}
                kind = pa.struct([("original", pa.int64()), ("compressed", pa.int64()), ("io", pa.int64())])
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([data], pa.binary()), pa.array([stats], kind)], names=[*batch.schema.names, "decoded", "stats"])

    return df.mapInArrow(run, out)


def read_anywhere(spark: SparkSession, path: str) -> DataFrame:
    """Whole archives of any store that Spark reads, decoded: path, decoded, stats."""
    return decode_column(spark.read.format("binaryFile").load(path).select("path", "content")).drop("content")


def extract_bundles(df: DataFrame, content: str = "content") -> DataFrame:
    """``(name, container)`` of the entries of bundles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                for name, body in codecs.bundle_entries(blob):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([body], pa.binary())], names=["name", "container"])

    return df.select(content).mapInArrow(run, "name string, container binary")


def verify(df: DataFrame, content: str = "content") -> DataFrame:
    """Whether the bytes of each container have the hash of its trailer (null without one)."""
    from pyspark.sql import functions as F

    decoded = decode_column(df, content)
    size = F.octet_length(content)
    has = F.expr(f"substring({content}, octet_length({content}) - 3, 4)") == F.lit(bytearray(wire.TRAILER_MAGIC))
    digest = F.lower(F.hex(F.expr(f"substring({content}, octet_length({content}) - 35, 32)")))
    return decoded.withColumn("verified", F.when(has & (size >= 36), F.sha2("decoded", 256) == digest))
