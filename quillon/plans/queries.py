"""Named queries over archives and tables, and their DuckDB SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import encodings as E
from ..operators.scratch import shared_path
from ..sources import archive, encode, wire
from ..streaming import events as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _archived(spark: SparkSession, d: str, name: str, key: str | None = None, **options: str) -> DataFrame:
    """A table written as archives (sorted by its key, so zone maps are narrow) and read again."""
    archive.register(spark)
    path = shared_path(spark, f"arc-{name}")
    rows = _table(spark, d, name)
    if key:
        parts = max(1, rows.rdd.getNumPartitions())
        rows = rows.repartitionByRange(parts, key).sortWithinPartitions(key)
    rows.write.format("archive").option("group", options.pop("group", "8192")).mode("append").save(path)
    return spark.read.format("archive").options(**options).load(path)


def _containers(df: DataFrame, make: Callable[[list[dict]], list[tuple[str, bytes]]]) -> DataFrame:
    """Rows of each Arrow batch as containers ``(name, content)``."""

    def run(batches):
        for batch in batches:
            made = make(batch.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in made], pa.string()), pa.array([c for _, c in made], pa.binary())], names=["name", "content"])

    return df.mapInArrow(run, "name string, content binary")


# ------------------------------------------------------------------ archives


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority in a key range, from an archive whose row groups are pruned."""
    return arc_prune_range(spark, sf_dir)


@query("SELECT * FROM orders")
def arc_scan_orders(spark, d):
    return _archived(spark, d, "orders", "o_orderkey")


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderkey BETWEEN 1000 AND 3000 GROUP BY ALL")
def arc_prune_range(spark, d):
    rows = _archived(spark, d, "orders", "o_orderkey", group="1024").where("o_orderkey BETWEEN 1000 AND 3000")
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def arc_project(spark, d):
    return _archived(spark, d, "orders", "o_orderkey", columns="o_orderkey,o_orderstatus")


@query("SELECT * FROM customer WHERE c_acctbal > 5000")
def arc_decimal_filter(spark, d):
    return _archived(spark, d, "customer", "c_custkey").where("c_acctbal > 5000")


@query("SELECT * FROM documents")
def arc_text(spark, d):
    return _archived(spark, d, "documents", "doc_id")


@query("SELECT event_id, user_id, event_type, props FROM events")
def arc_qjson_events(spark, d):
    rows = _table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type", "props")).alias("line"))

    def make(batch):
        made = encode.qjson("".join(r["line"] + "\n" for r in batch).encode())
        if made is None:
            raise wire.ArchiveError("lines differ in structure")
        return [("events", made)]

    decoded = archive.decode_column(_containers(rows, make))
    lines = decoded.select(F.explode(F.split(F.col("decoded").cast("string"), "\n", -1)).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", "event_id long, user_id long, event_type string, props string").alias("r")).select("r.*")


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def arc_columnar_customer(spark, d):
    rows = _table(spark, d, "customer").select("c_custkey", F.concat_ws(",", F.col("c_custkey").cast("string"), S.quoted(F.col("c_name")), F.col("c_nationkey").cast("string"), S.quoted(F.col("c_mktsegment"))).alias("line"))

    def make(batch):
        return [("customer", encode.csv(("key,name,nation,segment\n" + "".join(r["line"] + "\n" for r in batch)).encode()))]

    decoded = archive.decode_column(_containers(rows, make))
    lines = decoded.select(F.posexplode(F.split(F.col("decoded").cast("string"), "\n", -1)).alias("at", "line")).where("at > 0 and line <> ''")
    return lines.select(F.from_csv("line", "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").alias("r")).select("r.*")


@query("SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS val FROM embeddings")
def arc_embed(spark, d):
    """Vectors as one shuffled tensor for each batch, restored as floats."""
    rows = _table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<float>").alias("v"))

    def make(batch):
        import numpy as np

        out = []
        for r in batch:
            out.append((str(r["vec_id"]), encode.embed(b"", np.array(r["v"], "<f4").tobytes(), 4)))
        return out

    def floats(batches):
        import numpy as np

        for batch in batches:
            vec, pos, val = [], [], []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(data, "<f4")
                vec += [int(name)] * len(x)
                pos += range(len(x))
                val += x.astype(float).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(vec, pa.int64()), pa.array(pos, pa.int32()), pa.array(val, pa.float64())], names=["vec_id", "pos", "val"])

    decoded = archive.decode_column(_containers(rows, make))
    return decoded.select("name", "decoded").mapInArrow(floats, "vec_id long, pos int, val double")


@query("SELECT 'region' AS name, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier")
def arc_bundle(spark, d):
    """Three tables as entries of one bundle, counted after extraction."""
    parts = []
    for name in ("region", "nation", "supplier"):
        t = _table(spark, d, name)
        parts.append(t.select(F.lit(name).alias("t"), F.to_json(F.struct(*t.columns)).alias("line")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).coalesce(1)

    def make(batch):
        by: dict = {}
        for r in batch:
            by.setdefault(r["t"], []).append(r["line"])
        return [("bundle", encode.bundle([(f"tables/{t}.jsonl", encode.best("".join(x + "\n" for x in v).encode())) for t, v in by.items()]))]

    entries = archive.extract_bundles(_containers(rows, make))
    decoded = archive.decode_column(entries, "container")
    lines = decoded.select(F.regexp_extract("name", "tables/(.*)[.]jsonl", 1).alias("name"), F.explode(F.split(F.col("decoded").cast("string"), "\n", -1)).alias("line")).where("line <> ''")
    return lines.groupBy("name").agg(F.count("*").alias("n"))


@query("SELECT event_id, props FROM events")
def arc_frames(spark, d):
    """Lines in frames, one frame a batch; every frame decodes alone."""
    rows = _table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "props")).alias("line"))

    def make(batch):
        step = 1000
        return [("f", encode.frames(["".join(r["line"] + "\n" for r in batch[i : i + step]).encode() for i in range(0, len(batch), step)]))]

    decoded = archive.decode_column(_containers(rows, make))
    lines = decoded.select(F.explode(F.split(F.col("decoded").cast("string"), "\n", -1)).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", "event_id long, props string").alias("r")).select("r.*")


@query("SELECT doc_id, true AS verified, CAST(strlen(text) AS BIGINT) AS original FROM documents")
def arc_verify(spark, d):
    """Each text as the smallest verified container; its hash is checked again."""
    rows = _table(spark, d, "documents").select("doc_id", "text")
    made = _containers(rows, lambda batch: [(str(r["doc_id"]), encode.best((r["text"] or "").encode())) for r in batch])
    checked = archive.verify(made)
    return checked.select(F.col("name").cast("long").alias("doc_id"), "verified", F.col("stats.original").alias("original"))


@query("SELECT doc_id, true AS smaller FROM documents")
def arc_gate(spark, d):
    """No container is larger than the plainly compressed one with a trailer."""

    def make(batch):
        out = []
        for r in batch:
            data = (r["text"] or "").encode()
            out.append((str(r["doc_id"]), bytes([len(encode.best(data)) <= len(wire.raw(data)) + 36])))
        return out

    made = _containers(_table(spark, d, "documents").select("doc_id", "text"), make)
    return made.select(F.col("name").cast("long").alias("doc_id"), (F.hex("content") == "01").alias("smaller"))


@query("SELECT page_id, html FROM pages")
def arc_raw_pages(spark, d):
    made = _containers(_table(spark, d, "pages"), lambda batch: [(str(r["page_id"]), wire.raw((r["html"] or "").encode(), wire.XZ)) for r in batch])
    return archive.decode_column(made).select(F.col("name").cast("long").alias("page_id"), F.col("decoded").cast("string").alias("html"))


@query("SELECT event_id, props FROM events")
def arc_jsondoc(spark, d):
    """Each event's properties as a JSON document container."""
    made = _containers(_table(spark, d, "events").select("event_id", "props"), lambda batch: [(str(r["event_id"]), encode.json_document((r["props"] or "").encode())) for r in batch])
    return archive.decode_column(made).select(F.col("name").cast("long").alias("event_id"), F.col("decoded").cast("string").alias("props"))


@query("SELECT 'e' || event_id || ' user ' || user_id || ' did ' || event_type AS line FROM events")
def arc_log(spark, d):
    """Log lines as templates with holes, restored."""
    line = F.concat(F.lit("e"), F.col("event_id"), F.lit(" user "), F.col("user_id"), F.lit(" did "), F.col("event_type"))
    made = _containers(_table(spark, d, "events").select(line.alias("line")), lambda batch: [("log", encode.log("".join(r["line"] + "\n" for r in batch).encode()))])
    decoded = archive.decode_column(made)
    return decoded.select(F.explode(F.split(F.col("decoded").cast("string"), "\n", -1)).alias("line")).where("line <> ''")


@query("SELECT doc_id FROM documents WHERE contains(text, 'worthless')")
def arc_search(spark, d):
    """Full-text search over archived texts."""
    return _archived(spark, d, "documents", "doc_id", columns="doc_id,text").where(F.contains("text", F.lit("worthless"))).select("doc_id")


@query("SELECT o_orderstatus, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def arc_sql_join(spark, d):
    """SQL over archive views."""
    _archived(spark, d, "orders", "o_orderkey", columns="o_custkey,o_orderstatus").createOrReplaceTempView("arc_orders")
    _archived(spark, d, "customer", "c_custkey", columns="c_custkey,c_mktsegment").createOrReplaceTempView("arc_customer")
    return spark.sql("SELECT o_orderstatus, c_mktsegment, count(*) AS n FROM arc_orders JOIN arc_customer ON o_custkey = c_custkey GROUP BY ALL")


# ------------------------------------------------------------------ encodings as relations


@query("SELECT o_orderkey, o_custkey - lag(o_custkey, 1, 0) OVER (PARTITION BY o_orderkey // 8192 ORDER BY o_orderkey) AS delta FROM orders")
def delta_encode(spark, d):
    return E.delta_encode(_table(spark, d, "orders"), "o_orderkey", "o_custkey", E.frame_of(F.col("o_orderkey"))).select("o_orderkey", "delta")


@query("SELECT o_orderkey, CASE WHEN x >= 0 THEN 2 * x ELSE -2 * x - 1 END AS z FROM (SELECT o_orderkey, o_custkey - lag(o_custkey, 1, 0) OVER (PARTITION BY o_orderkey // 8192 ORDER BY o_orderkey) AS x FROM orders)")
def zigzag(spark, d):
    return delta_encode(spark, d).select("o_orderkey", S.zigzag(F.col("delta")).alias("z"))


@query("SELECT o_orderkey, o_custkey FROM orders")
def delta_decode(spark, d):
    deltas = E.delta_encode(_table(spark, d, "orders"), "o_orderkey", "o_custkey", E.frame_of(F.col("o_orderkey"))).select("o_orderkey", "frame", S.unzigzag(S.zigzag(F.col("delta"))).alias("delta"))
    return E.delta_decode(deltas, "o_orderkey", "delta", "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT event_type, row_number() OVER (ORDER BY min(event_id)) - 1 AS code FROM events GROUP BY event_type")
def dict_first_seen(spark, d):
    return E.dictionary_encode(_table(spark, d, "events"), "event_id", "event_type")


@query("SELECT event_id, event_type FROM events")
def dict_decode(spark, d):
    t = _table(spark, d, "events")
    words = E.dictionary_encode(t, "event_id", "event_type")
    return E.dictionary_decode(t.join(words, "event_type").select("event_id", "code"), words).select("event_id", "event_type")


@query("SELECT n_nationkey, count(DISTINCT n_regionkey) AS targets FROM nation GROUP BY n_nationkey")
def derived_fd(spark, d):
    return E.determines(_table(spark, d, "nation"), "n_nationkey", "n_regionkey")


@query("SELECT o_orderkey, o_orderkey & 255 AS plane0, (o_orderkey >> 8) & 255 AS plane1 FROM orders")
def byte_planes(spark, d):
    return _table(spark, d, "orders").select("o_orderkey", S.byte_plane(F.col("o_orderkey"), 0).alias("plane0"), S.byte_plane(F.col("o_orderkey"), 1).alias("plane1"))


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS unscaled, true AS same FROM orders")
def dec_unscaled(spark, d):
    u = S.unscaled(F.col("o_totalprice"), 2)
    return _table(spark, d, "orders").select("o_orderkey", u.alias("unscaled"), (S.fixed_text(u, 2).cast("double") == F.round("o_totalprice", 2)).alias("same"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey END AS number,
       CASE WHEN c_custkey % 7 = 0 THEN 'n/a' || c_custkey END AS exception FROM customer""")
def numexc_classify(spark, d):
    mixed = _table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("n/a"), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string")).alias("cell"))
    return E.classify_numeric(mixed, "cell").select("c_custkey", "number", "exception")


@query("SELECT doc_id, '\"' || replace(text, '\"', '\"\"') || '\"' AS cell FROM documents")
def csv_quote(spark, d):
    return _table(spark, d, "documents").select("doc_id", S.quoted(F.col("text")).alias("cell"))


@query("SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents")
def line_split(spark, d):
    return E.lines(_table(spark, d, "documents"), "doc_id", "text")


@query("SELECT event_id, event_type FROM events ORDER BY event_id")
def verbatim_merge(spark, d):
    t = _table(spark, d, "events").select("event_id", "event_type")
    return E.interleave(t.where("event_id % 3 <> 0"), t.where("event_id % 3 = 0"), "event_id")


@query("SELECT o_orderkey // 1024 AS grp, min(o_custkey) AS low, max(o_custkey) AS high, count(*) AS n FROM orders GROUP BY 1")
def zone_map(spark, d):
    return E.zone_map(_table(spark, d, "orders"), "o_orderkey", "o_custkey", 1024)


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def sha256_docs(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT lang, CAST(sum(octet_length(encode(text))) AS BIGINT) AS octets, count(*) AS n FROM documents GROUP BY lang")
def octets(spark, d):
    return _table(spark, d, "documents").groupBy("lang").agg(F.sum(F.octet_length("text")).alias("octets"), F.count("*").alias("n"))


@query("SELECT regexp_replace(props, '[0-9]+', '<*>', 'g') AS template, count(*) AS n FROM events GROUP BY 1")
def log_template(spark, d):
    return _table(spark, d, "events").groupBy(S.template_of(F.col("props")).alias("template")).agg(F.count("*").alias("n"))


@query("SELECT event_id, props FROM events")
def log_fill(spark, d):
    p = F.col("props")
    return _table(spark, d, "events").select("event_id", S.filled(S.template_of(p), S.holes_of(p)).alias("props"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_leaf(spark, d):
    return _table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, epoch_us(ts) AS us FROM events")
def epoch_us(spark, d):
    return _table(spark, d, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS t FROM events")
def epoch_text(spark, d):
    return _table(spark, d, "events").select("event_id", S.epoch_text(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("t"))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def sparse_matrix(spark, d):
    return E.sparse_matrix(_table(spark, d, "events"), "user_id", "event_type")


@query("SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS val FROM embeddings")
def tensor_explode(spark, d):
    return E.explode_tensor(_table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("val", F.col("val").cast("double"))


# ------------------------------------------------------------------ SQL over the tables


def _sql(name: str, tables: str, text: str, oracle: str | None = None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        for t in tables.split():
            _table(spark, d, t).createOrReplaceTempView(t)
        return spark.sql(text)

    run.__name__ = name
    query(oracle or text)(run)


_sql("semi", "orders customer", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
_sql("anti", "orders customer", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
_sql("rollup", "lineitem", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
_sql("cube", "lineitem", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
_sql("filter_agg", "lineitem", "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_quantity < 24 AND l_discount BETWEEN 0.05 AND 0.07")
_sql("pricing", "lineitem", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net, round(avg(l_discount), 6) AS discount, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
_sql("revenue_by_region", "region nation customer orders", "SELECT r_name, n_name, round(sum(o_totalprice), 2) AS revenue FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY r_name, n_name")
_sql("tumble", "events", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
_sql("top_k", "orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
_sql("rank_per_key", "orders", "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn FROM orders")
_sql("except_keys", "orders customer", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders WHERE o_totalprice > 150000")
_sql("except_all_rows", "lineitem", "SELECT l_suppkey AS k FROM lineitem EXCEPT ALL SELECT l_suppkey AS k FROM lineitem WHERE l_quantity < 25")
_sql("intersect_all_rows", "lineitem", "SELECT l_suppkey AS k FROM lineitem WHERE l_quantity < 10 INTERSECT ALL SELECT l_suppkey AS k FROM lineitem WHERE l_quantity > 40")
_sql("union_keys", "orders customer", "SELECT c_custkey AS k FROM customer UNION SELECT o_orderkey AS k FROM orders")
_sql("union_all_rows", "supplier customer", "SELECT c_nationkey AS k, c_acctbal AS v FROM customer UNION ALL SELECT s_nationkey AS k, s_acctbal AS v FROM supplier")
_sql("left_join", "orders customer", "SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_totalprice > 200000")
_sql("right_join", "orders customer", "SELECT c.c_custkey, o.o_orderkey FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice < 5000")
_sql("full_join", "supplier customer", "SELECT c.c_custkey, s.s_suppkey FROM customer c FULL JOIN supplier s ON s.s_suppkey = c.c_custkey AND s.s_acctbal > 0")
_sql("cross_join", "region nation", "SELECT r_name, n_name FROM region CROSS JOIN nation")
_sql("theta_join", "nation region", "SELECT r_name, n_name FROM region JOIN nation ON n_regionkey < r_regionkey")
_sql("grouping_sets", "lineitem", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
_sql(
    "map_counts",
    "events",
    "SELECT user_id, CAST(m['purchase'] AS BIGINT) AS purchases, CAST(size(map_keys(m)) AS BIGINT) AS kinds FROM (SELECT user_id, map_from_entries(collect_list(struct(event_type, n))) AS m FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY user_id)",
    "SELECT user_id, nullif(count(*) FILTER (event_type = 'purchase'), 0) AS purchases, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id",
)
_sql(
    "approx_distinct",
    "lineitem",
    "SELECT l_returnflag, abs(approx_count_distinct(l_orderkey, 0.01) - count(DISTINCT l_orderkey)) <= 0.05 * count(DISTINCT l_orderkey) AS near FROM lineitem GROUP BY l_returnflag",
    "SELECT DISTINCT l_returnflag, true AS near FROM lineitem",
)
_sql("intersect_keys", "orders customer", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey AS k FROM orders")


@query("""SELECT e.event_id, arg_max(p.value, p.event_id) AS prior FROM events e
LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.event_id <= e.event_id GROUP BY e.event_id""")
def asof(spark, d):
    """For each event its user's last purchase at or before it."""
    t = _table(spark, d, "events")
    return E.as_of(t.select("event_id", "user_id"), t.where("event_type = 'purchase'"), "user_id", "event_id", "value", "prior").select("event_id", "prior")


@query("""SELECT user_id, min(ts) AS start, max(ts) AS stop, count(*) AS n FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s""")
def session(spark, d):
    """Sessions of a user with gaps under six hours."""
    t = _table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    g = t.groupBy("user_id", F.session_window("at", "6 hours")).agg(F.min("ts").alias("start"), F.max("ts").alias("stop"), F.count("*").alias("n"))
    return g.select("user_id", "start", "stop", "n")


@query("""SELECT p.p_partkey, b.lo FROM part p JOIN (SELECT unnest([900, 1000, 1100, 1200]) AS lo) b ON p.p_retailprice BETWEEN b.lo AND b.lo + 150""")
def interval_join(spark, d):
    spans = spark.createDataFrame([(x, x + 150) for x in (900, 1000, 1100, 1200)], "lo int, hi int")
    return E.interval_join(_table(spark, d, "part"), spans, "p_retailprice", "lo", "hi", 100).select("p_partkey", "lo")


@query("SELECT n_name, n_name[1] || '-' || length(n_name) AS tag FROM nation")
def vector_udf(spark, d):
    """A function of whole Arrow columns."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def tag(name: pd.Series) -> pd.Series:
        return name.str[:1] + "-" + name.str.len().astype(str)

    return _table(spark, d, "nation").select("n_name", tag("n_name").alias("tag"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def word_table_function(spark, d):
    """A table function of Python, joined laterally."""

    @F.udtf(returnType="word: string")
    class Words:
        def eval(self, text: str):
            for w in (text or "").split(" "):
                yield (w,)

    return _table(spark, d, "part").lateralJoin(Words(F.col("p_name").outer())).select("p_partkey", "word")


@query("SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0")
def arc_append(spark, d):
    """Two jobs append to one path."""
    archive.register(spark)
    path, rows = shared_path(spark, "arc-append"), _table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    for part in (rows, rows.where("o_orderkey % 2 = 0")):
        part.write.format("archive").mode("append").save(path)
    return spark.read.format("archive").load(path)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey > 5")
def arc_overwrite(spark, d):
    """A job that replaces the files of another, by fewer tasks."""
    archive.register(spark)
    path, rows = shared_path(spark, "arc-over"), _table(spark, d, "nation").select("n_nationkey", "n_name")
    rows.repartition(4).write.format("archive").mode("append").save(path)
    rows.where("n_nationkey > 5").coalesce(1).write.format("archive").mode("overwrite").save(path)
    return spark.read.format("archive").load(path)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45 OR l_quantity < 3")
def arc_nan_prune(spark, d):
    """Quantities below three become NaN, which is above all numbers; groups with NaN are not pruned away."""
    archive.register(spark)
    path = shared_path(spark, "arc-nan")
    x = F.when(F.col("l_quantity") < 3, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double"))
    _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x")).write.format("archive").option("group", "512").mode("append").save(path)
    return spark.read.format("archive").load(path).where("x > 45").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, CAST(CAST(round(o_totalprice, 2) AS DECIMAL(14, 2)) AS DOUBLE) AS price, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, o_totalprice > 100000 AS large FROM orders")
def arc_types(spark, d):
    """Decimals, dates and truth values."""
    archive.register(spark)
    path = shared_path(spark, "arc-types")
    rows = _table(spark, d, "orders").select("o_orderkey", F.round("o_totalprice", 2).cast("decimal(14,2)").alias("price"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") > 100000).alias("large"))
    rows.write.format("archive").mode("append").save(path)
    return spark.read.format("archive").load(path).select("o_orderkey", F.col("price").cast("double").alias("price"), F.col("day").cast("string").alias("day"), "large")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumble(spark, d):
    return streams.tumbling(spark, d)


@query("SELECT h - INTERVAL (k) HOUR AS start, count(*) AS n FROM (SELECT date_trunc('hour', ts) AS h, unnest([0, 1]) AS k FROM events) GROUP BY 1")
def stream_slide(spark, d):
    return streams.sliding(spark, d)


@query("SELECT n_nationkey, n_name FROM nation")
def stream_frames(spark, d):
    """A frame container read as a stream, a few frames at a time."""
    archive.register(spark)
    path = shared_path(spark, "frames") + ".arc"
    # Nations have a fixed number of rows.
    rows = _table(spark, d, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").toPandas().to_dict("records")
    parts = ["".join(json.dumps(r) + "\n" for r in rows[i : i + 5]).encode() for i in range(0, len(rows), 5)]
    fs, at = archive.file_system(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(at) as f:
        f.write(encode.frames(parts))
    lines = streams.frames(spark, path)
    return lines.select(F.from_json("value", "n_nationkey int, n_name string").alias("r")).select("r.*")


__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
