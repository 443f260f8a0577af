"""The archive source: pruning, nulls, permissive decoding."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from quillon.sources import archive, encode, wire


def test_pruning_reads_fewer_partitions_and_the_same_rows(spark, tmp_path):
    archive.register(spark)
    path = str(tmp_path / "t")
    spark.range(10_000, numPartitions=1).select("id", (F.col("id") / 8).alias("x"), F.col("id").cast("string").alias("s")).write.format("archive").option("group", "500").mode("append").save(path)
    on = spark.read.format("archive").option("splitBytes", "1").load(path).where("id between 1000 and 1700 and x < 200")
    off = spark.read.format("archive").option("prune", "false").option("splitBytes", "1").load(path).where("id between 1000 and 1700 and x < 200")
    assert sorted(on.collect()) == sorted(off.collect())
    assert on.count() == 600
    assert on.rdd.getNumPartitions() < off.rdd.getNumPartitions() == 20
    # Small groups share a split.
    assert spark.read.format("archive").load(path).rdd.getNumPartitions() == 1


def test_appends_and_overwrites_keep_the_right_rows(spark, tmp_path):
    archive.register(spark)
    path = str(tmp_path / "t")
    count = lambda: spark.read.format("archive").load(path).count()
    put = lambda n, parts, mode: spark.range(n, numPartitions=parts).write.format("archive").mode(mode).save(path)
    put(1000, 2, "append")
    put(1000, 2, "append")
    assert count() == 2000
    put(300, 3, "overwrite")
    assert count() == 300
    put(10, 1, "overwrite")
    assert count() == 10 and [r.id for r in spark.read.format("archive").load(path).orderBy("id").collect()] == list(range(10))
    put(50, 5, "overwrite")
    put(7, 1, "append")
    assert count() == 57
    put(0, 1, "overwrite")
    assert count() == 0 and spark.read.format("archive").load(path).columns == ["id"]
    put(3, 1, "append")
    assert count() == 3 and not [f for f in (tmp_path / "t").iterdir() if f.suffix == ".tmp"]


def test_nan_is_above_all_numbers(spark, tmp_path):
    archive.register(spark)
    path = str(tmp_path / "t")
    rows = [float("nan"), 1.0, 5.0, None, float("inf"), float("-inf"), 0.0, -0.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x double").coalesce(1)
    df.write.format("archive").option("group", "2").mode("append").save(path)
    for test in ("x = double('NaN')", "x = 5", "x > 2", "x > double('Infinity')", "x >= double('NaN')", "x < double('NaN')", "x <= 0", "x in (5, double('NaN'))", "x is null", "x < 1", "x = 0"):
        assert sorted(r.i for r in spark.read.format("archive").load(path).where(test).collect()) == sorted(r.i for r in df.where(test).collect()), test


def test_every_type_is_read_back_or_refused(spark, tmp_path):
    archive.register(spark)
    path = str(tmp_path / "t")
    row = "CAST(1.50 AS decimal(12,2)) d, CAST(-7 AS smallint) s, CAST(3 AS tinyint) b, true t, date'2020-02-29' day, CAST(0.1 AS float) f, timestamp'2020-01-02 03:04:05.000006' at, timestamp_ntz'1969-12-31 23:59:59.999999' n"
    df = spark.sql(f"SELECT {row} UNION ALL SELECT null, null, null, false, null, CAST('-Infinity' AS float), null, null UNION ALL SELECT -99999999.99, 32767, -128, null, date'0001-01-01', null, timestamp'1900-01-01 00:00:00', null")
    df.write.format("archive").mode("append").save(path)
    back = spark.read.format("archive").load(path)
    key = lambda r: repr(tuple(r))
    assert back.schema.simpleString() == df.schema.simpleString() and sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
    assert back.where("d = 1.50 and day = date'2020-02-29' and t").count() == 1
    with pytest.raises(Exception, match="no cells for the type"):
        spark.sql("SELECT array(1) AS a").write.format("archive").mode("append").save(str(tmp_path / "refused"))


def test_json_nests_to_the_format_limit():
    from quillon.sources import codecs

    def nested(depth):
        tape = (b"\x02\x01" * depth) + b"\x02\x00"
        return codecs.json_lines({"meta": b"\x01\x00", "flags": b"\x01", "value_index": b"\x00", "tape": tape})

    assert nested(8191) == b"[" * 8192 + b"]" * 8192
    with pytest.raises(wire.ArchiveError, match="too deep"):
        nested(8192)


def test_nulls_newlines_and_types_survive(spark, tmp_path):
    archive.register(spark)
    path = str(tmp_path / "t")
    rows = [(1, None, "a\nb\\n", 0.1, datetime.datetime(2020, 1, 2, 3, 4, 5, 6)), (None, 7, None, None, None), (-(1 << 63), 0, "\\N", -1e300, None), (5, 5, "", 1.5, None)]
    df = spark.createDataFrame(rows, "a bigint, b int, s string, x double, t timestamp_ntz").coalesce(1)
    df.write.format("archive").mode("append").save(path)
    key = lambda r: repr(tuple(r))
    assert sorted(spark.read.format("archive").load(path).collect(), key=key) == sorted(df.collect(), key=key)
    assert [r.a for r in spark.read.format("archive").load(path).where("a = 5").collect()] == [5]


def test_modes_of_decoding(spark):
    good, bad = wire.with_trailer(wire.raw(b"hi"), b"hi"), wire.with_trailer(wire.raw(b"hi"), b"ho")
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(bad)), (3, None)], "i int, content binary")
    assert [r.i for r in archive.decode_column(df, mode="DROPMALFORMED").collect()] == [1]
    assert {r.i: r.decoded for r in archive.decode_column(df, mode="PERMISSIVE").collect()} == {1: bytearray(b"hi"), 2: None, 3: None}
    with pytest.raises(Exception, match="hash differs|no input"):
        archive.decode_column(df).collect()
    assert archive.verify(df.where("i = 1")).first().verified


def test_binary_files_decode(spark, tmp_path):
    (tmp_path / "a.arc").write_bytes(encode.best(b"a,b\n1,2\n3,4\n"))
    assert bytes(archive.read_anywhere(spark, str(tmp_path)).first().decoded) == b"a,b\n1,2\n3,4\n"
