"""Column encodings as relational operators.

Prefix sums need a total order.  Each works within a frame, as containers do, so windows are
partitioned by it; a frame of fixed size bounds the rows of one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRAME = 8192


def frame_of(key: Column, size: int = FRAME) -> Column:
    """Frame number of an ascending integer key."""
    return F.floor(key / size).cast("long")


def delta_encode(df: DataFrame, key: str, value: str, frame: Column) -> DataFrame:
    """``value`` less the one before it in its frame; the first as it is."""
    w = Window.partitionBy("_f").orderBy(key)
    return df.withColumn("_f", frame).withColumn("delta", F.col(value) - F.lag(value, 1, 0).over(w)).withColumnRenamed("_f", "frame")


def delta_decode(df: DataFrame, key: str, delta: str, out: str) -> DataFrame:
    """The values again, as running sums within each frame."""
    w = Window.partitionBy("frame").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(delta).over(w))


def dictionary_encode(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(value, code)``: codes by first appearance.

    The dictionary is aggregated first, so only distinct values are ranked in one task.
    """
    firsts = df.groupBy(value).agg(F.min(key).alias("first"))
    return firsts.select(value, (F.row_number().over(Window.orderBy("first")) - 1).cast("long").alias("code"))


def dictionary_decode(codes: DataFrame, dictionary: DataFrame, code: str = "code") -> DataFrame:
    return codes.join(dictionary, code)


def determines(df: DataFrame, source: str, target: str) -> DataFrame:
    """For each source value the number of target values; 1 throughout if it determines them."""
    return df.groupBy(source).agg(F.count_distinct(target).alias("targets"))


def classify_numeric(df: DataFrame, value: str) -> DataFrame:
    """Which cells a number encoding restores exactly; the rest are exceptions."""
    number = F.expr(f"try_cast({value} as bigint)")
    same = F.coalesce(number.cast("string") == F.col(value), F.lit(False))
    return df.select("*", F.when(same, number).alias("number"), F.when(~same, F.col(value)).alias("exception"))


def zone_map(df: DataFrame, key: str, value: str, group: int) -> DataFrame:
    """Least, most and rows for each group of ``group`` consecutive keys."""
    return df.groupBy(F.floor(F.col(key) / group).cast("long").alias("grp")).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n"))


def interleave(structured: DataFrame, verbatim: DataFrame, line: str) -> DataFrame:
    """Two ordered sequences as one, by line number."""
    return structured.unionByName(verbatim).orderBy(line)


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def explode_tensor(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.posexplode(vector).alias("pos", "val"))


def sparse_matrix(df: DataFrame, row: str, col: str) -> DataFrame:
    return df.groupBy(row, col).agg(F.count("*").alias("n"))


def as_of(left: DataFrame, right: DataFrame, by: str, on: str, value: str, out: str) -> DataFrame:
    """For each left row the last right value at or before it, per key; one sort, no pair join."""
    a = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    missing = [c for c in left.columns if c not in (by, on)]
    b = right.select(by, on, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in missing], F.lit(0).alias("_side"), F.col(value).alias("_v"))
    w = Window.partitionBy(by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn(out, F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_side", "_v")


def interval_join(points: DataFrame, spans: DataFrame, at: str, low: str, high: str, width: int) -> DataFrame:
    """Points within spans: spans are dealt to the buckets that they touch, then joined by bucket."""
    p = points.withColumn("_b", F.floor(F.col(at) / width))
    s = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(s, "_b").where(F.col(at).between(F.col(low), F.col(high))).drop("_b")
