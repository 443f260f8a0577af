"""Cross-site boilerplate lines.

A line is boilerplate if it occurs on at least ``min_sites`` distinct sites and in more than one
distinct text.  Lines are hashed.  A first aggregation leaves one row per line and site; it combines on
the map side, so a line that stands in a third of all rows sends as many rows as it has sites.  Lines of
a single site are dropped.  For the rest, HyperLogLog sketches of the sites merge by aggregation, per
line hash.  Lines whose estimate lies near the threshold get an exact distinct count, the others are
decided by their estimate.  Then boilerplate is cut from every document, at any share of it.

Rules: lines are the parts between newlines, compared without leading and trailing spaces; blank
lines are never boilerplate.  Lines that no other text holds than the exact copies (by hash) of one text
are no boilerplate: those are copies of a document, which near-duplicate removal treats.  A null source
is a site of its own.  A null text stays null and has no lines, an empty one has one blank line.
Repeated rows are treated alike, an empty table stays empty.  Extra columns are carried along whatever
their names; where one has the name of an added column, the added one gets underscores behind its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_written, free_name, salted_left_join, table, written

MIN_SITES = 5
#: Sketches of 2^10 registers: a relative error of about 3 % once they leave their exact small modes.
LG_REGISTERS = 10
#: Estimates within this share of the threshold are counted exactly.
NEAR = 0.5

_TRIM = " \t\r\x0b\x0c"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_TRIM))


def boilerplate_lines(docs: DataFrame, site_col: str = "source", text_col: str = "text", min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """``(line)``: the hashes of lines found on at least ``min_sites`` distinct sites and in several texts."""
    sites = F.xxhash64(F.col(site_col).isNull(), F.col(site_col))
    lines = docs.where(F.col(text_col).isNotNull()).select(sites.alias("site"), F.xxhash64(text_col).alias("text"), F.explode(F.split(F.col(text_col), "\n")).alias("raw"))
    lines = lines.select("site", "text", _bare(F.col("raw")).alias("raw")).where("raw <> ''").select("site", "text", F.xxhash64("raw").alias("line"))
    # One row per line and site, written once: read by the first pass, the sketches and the exact counts.
    spread = written(lines.groupBy("line", "site").agg(F.min("text").alias("low"), F.max("text").alias("high")), "spread")
    several = spread.groupBy("line").agg(F.min("site").alias("one"), F.max("site").alias("other"), F.min("low").alias("low"), F.max("high").alias("high"))
    several = several.where("low <> high" if min_sites <= 1 else "low <> high and one <> other").select("line")
    if min_sites <= 1:
        return several
    shared = written(spread.select("line", "site").join(several, "line"), "shared")
    drop_written(spread)
    sketched = shared.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_REGISTERS))).alias("estimate"))
    sketched = written(sketched.where(F.col("estimate") >= (1 - near) * min_sites), "sketched")
    sure = sketched.where(F.col("estimate") > (1 + near) * min_sites).select("line")
    unsure = sketched.where(F.col("estimate") <= (1 + near) * min_sites).select("line")
    exact = shared.join(unsure, "line").groupBy("line").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites).select("line")
    return sure.union(exact)


def remove_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, and ``n_lines`` and ``n_removed`` added."""
    bad = written(boilerplate_lines(docs, site_col, text_col, min_sites).withColumn("bad", F.lit(True)), "boilerplate")
    # Equal texts lose equal lines, so positions are found once per distinct text.
    lines = docs.where(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("text"), F.posexplode(F.split(F.col(text_col), "\n")).alias("at", "raw"))
    lines = lines.select("text", "at", _bare(F.col("raw")).alias("raw")).where("raw <> ''").select("text", "at", F.xxhash64("raw").alias("line"))
    hit = salted_left_join(lines, bad, ["line"], 16).where("bad").select("text", "at").distinct()
    hit = hit.groupBy("text").agg(F.sort_array(F.collect_list("at")).alias("places"))
    key, places = free_name(docs.columns, "text_key"), free_name(docs.columns, "places")
    joined = docs.withColumn(key, F.xxhash64(text_col)).join(hit.toDF(key, places), key, "left").drop(key)
    parts = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(places), i)), "\n")
    added = {
        free_name(docs.columns, "n_lines"): F.when(F.col(text_col).isNull(), 0).otherwise(F.size(parts)).cast("long"),
        free_name(docs.columns, "n_removed"): F.coalesce(F.size(places), F.lit(0)).cast("long"),
        text_col: F.when(F.col(places).isNotNull(), kept).otherwise(F.col(text_col)),
    }
    return joined.withColumns(added).drop(places)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut from each document, and the length and hash of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = remove_boilerplate(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH l AS (
  SELECT d.rid, d.doc_id, d.source, d.text, u.pos, trim(u.raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line, u.raw
  FROM (SELECT *, row_number() OVER () AS rid FROM documents) d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS raw, generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) u),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= {MIN_SITES} AND min(text) <> max(text)),
m AS (SELECT l.*, (b.line IS NOT NULL) AS bad FROM l LEFT JOIN b USING (line)),
s AS (
  SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS rest
  FROM m GROUP BY rid)
SELECT doc_id, n_lines, n_removed, CAST(length(rest) AS BIGINT) AS kept_chars, sha256(rest) AS kept_sha256
FROM s"""
