"""Mixing sources to target weights by min-cost flow.

A text that stands in several sources belongs to all of them.  Rows are aggregated by membership pattern:
the set of the sources in which their text (by hash) is found.  A pattern offers the words of its distinct
texts once at no cost; every further time costs more, a convex cost of repetition, whichever source's row
is used.  So quotas are filled from texts of one source first where a shared text could serve several.
A min-cost flow routes that capacity to the quotas of the sources; what a source's own rows can take of a
pattern is bounded by their number of repetitions.  The flow between a pattern and a source says how often
the rows of that cell are taken; which ones get the partial repetition is decided by a seeded hash, size
class by size class, so that each class takes its share and what a class leaves over passes to the next
smaller one.

The driver holds one row for each pattern and source (at most ``MOST_CELLS``; beyond that ``plan``
refuses).  Cuts within a cell are found on the executors, from sums of size class and hash bucket.
Networks that share no source are solved apart.  Null sources are a source of their own, last in order.
A null text has no words.  The selection depends on the doc_id, the text and the seed alone, so reruns agree
and repeated rows are treated alike.  Extra columns are carried by ``mix`` unchanged, whatever their
names.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PATTERN, free_name, local_table, salted_left_join, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = 17
#: Hash buckets of a size class, from which the cut is chosen.
BUCKETS = 512
#: Pairs of pattern and source that the driver's flow may have.
MOST_CELLS = 1_000_000


def targets(sizes: dict, weights: dict, share: float = SHARE, most: float = REPEATS) -> dict:
    """Targets in words: ``share`` of all sizes by weight, none above ``most`` times its size.

    What a full source cannot take is shared by weight among the others, until none is above.
    """
    total, out, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        weight = sum(weights[s] for s in open_)
        left = total - sum(out.values())
        full = {s for s in open_ if left * weights[s] / weight >= most * sizes[s]}
        if not full:
            return out | {s: left * weights[s] / weight for s in open_}
        out |= {s: most * sizes[s] for s in full}
        open_ -= full
    return out


def min_cost_flow(cells: dict, distinct: dict, quotas: dict, repeats: int = REPEATS) -> dict:
    """Words routed for each (pattern, source), of the sizes of these cells.

    ``distinct`` has the words of a pattern's distinct texts: their n-th use costs n - 1 a word.  A cell
    gives at most ``repeats`` times its size.  As much of the quotas is filled as that allows, at the
    least cost, by successive shortest paths with potentials.
    """
    flow: dict = defaultdict(float)
    for patterns, sources in _networks(distinct, quotas):
        flow.update(_solve({p: distinct[p] for p in patterns}, {(p, s): cells[p, s] for p in patterns for s in p if (p, s) in cells}, {s: quotas[s] for s in sources}, repeats))
    return dict(flow)


def _networks(patterns, quotas: dict):
    """Patterns and sources that hang together."""
    parent = {s: s for s in quotas}

    def root(s):
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for p in patterns:
        for s in p[1:]:
            parent[root(s)] = root(p[0])
    groups: dict = defaultdict(lambda: ([], []))
    for p in patterns:
        if p:
            groups[root(p[0])][0].append(p)
    for s in quotas:
        groups[root(s)][1].append(s)
    return [g for g in groups.values() if g[0]]


def _solve(distinct: dict, cells: dict, quotas: dict, repeats: int) -> dict:
    edges: list[list] = []  # to, room, cost
    out: dict = defaultdict(list)

    def add(a, b, room, cost) -> int:
        out[a].append(len(edges))
        edges.append([b, room, cost])
        out[b].append(len(edges))
        edges.append([a, 0.0, -cost])
        return len(edges) - 2

    routes = {}
    room: dict = defaultdict(float)
    for (p, s), size in sorted(cells.items(), key=lambda x: repr(x[0])):
        room[p] += repeats * size
        routes[p, s] = add(("p", p), ("s", s), float(repeats * size), 0)
    for p, size in sorted(distinct.items(), key=lambda x: repr(x[0])):
        n = 0
        while room[p] > 0 and size > 0:
            # Few uses cost apart; what copies allow beyond them is one more step.
            part = min(float(size), room[p]) if n < 2 * repeats else room[p]
            add("start", ("p", p), part, n)
            room[p], n = room[p] - part, n + 1
    for s, quota in sorted(quotas.items(), key=lambda x: repr(x[0])):
        add(("s", s), "stop", float(quota), 0)
    price: dict = defaultdict(float)
    tiny = 1e-9 * max(1.0, sum(quotas.values()))
    while True:
        far, via, heap, tick = {"start": 0.0}, {}, [(0.0, 0, "start")], 0
        while heap:
            d, _, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i in out[a]:
                b, room, cost = edges[i]
                new = d + cost + price[a] - price[b]
                if room > tiny and new < far.get(b, float("inf")) - 1e-12:
                    far[b], via[b], tick = new, i, tick + 1
                    heapq.heappush(heap, (new, tick, b))
        if "stop" not in far:
            break
        for a, d in far.items():
            price[a] += d
        path, at = [], "stop"
        while at != "start":
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        room = min(edges[i][1] for i in path)
        for i in path:
            edges[i][1] -= room
            edges[i ^ 1][1] += room
    return {k: edges[i ^ 1][1] for k, i in routes.items() if edges[i ^ 1][1] > tiny}


def cuts(cells: list[tuple[int, int, int]], extra: float) -> dict[int, int]:
    """For each size class the number of hash buckets whose documents are taken once more.

    ``cells`` has (class, bucket, words) of one pattern; ``extra`` are the words wanted.  Classes
    go from large to small; each takes its share plus what the larger ones left over.
    """
    by: dict = defaultdict(list)
    for c, b, w in cells:
        by[c].append((b, w))
    total = sum(w for _, _, w in cells)
    part = min(1.0, extra / total) if total else 0.0
    out, owed = {}, 0.0
    for c in sorted(by, reverse=True):
        goal = owed + part * sum(w for _, w in by[c])
        got, cut, best = 0.0, 0, (abs(goal), 0, 0.0)
        for b, w in sorted(by[c]):
            got, cut = got + w, b + 1
            if abs(goal - got) < best[0]:
                best = (abs(goal - got), cut, got)
        out[c], owed = best[1], goal - best[2]
    return out


def turned_cuts(cells: list[tuple[int, int, int]], extra: float, turns: int = 16) -> tuple[int, dict[int, int]]:
    """The first bucket and :func:`cuts` from there, for the turn that comes nearest to ``extra``.

    With many documents the first turn is near enough; with few the others offer other sums.
    """
    best = None
    for start in range(0, BUCKETS, BUCKETS // turns):
        turned = [(c, (b - start) % BUCKETS, w) for c, b, w in cells]
        found = cuts(turned, extra)
        off = abs(extra - sum(w for c, b, w in turned if b < found[c]))
        if best is None or off < best[0]:
            best = (off, start, found)
        if best[0] <= 0.001 * extra:
            break
    return best[1:]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def units(docs: DataFrame, inner: dict, seed: int = SEED) -> DataFrame:
    """``docs`` with the columns of selection, under the names of ``inner``: size, size class, hash bucket, mark of the text, cell."""
    size, mark = words(F.col("text")), F.xxhash64(F.col("text").isNull(), F.col("text").cast("string"))
    out = docs.withColumns({inner["size"]: size, inner["mark"]: mark, inner["source"]: F.col("source").cast("string")})
    size = F.col(inner["size"])
    level = F.when(size > 0, F.floor(F.log2(size.cast("double"))) + 1).otherwise(0).cast("int")
    return out.withColumns({inner["level"]: level, inner["bucket"]: F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col(inner["mark"])), F.lit(BUCKETS)).cast("int")})


_CHOICE = "pattern string, source string, level int, base int, start int, cut int, got long"


def _cut_cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Cuts of one cell: at most the size classes times the hash buckets as rows."""
    extra, base = float(rows["extra"].iloc[0]), int(rows["base"].iloc[0])
    start, chosen = turned_cuts(list(zip(rows["level"].tolist(), rows["bucket"].tolist(), rows["size"].tolist(), strict=True)), extra)
    out = rows.assign(cut=rows["level"].map(lambda x: chosen.get(x, 0)), base=base, start=start)
    out["got"] = out["size"] * (out["base"] + ((out["bucket"] - start) % BUCKETS < out["cut"]))
    kept = {c: "first" for c in ("pattern", "source", "base", "start", "cut")} | {"got": "sum"}
    return out.groupby("level", as_index=False).agg(kept)[["pattern", "source", "level", "base", "start", "cut", "got"]]


def plan(sized: DataFrame, weigh=None, share: float = SHARE, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame]:
    """``(patterns, choice)`` for ``sized`` (source, mark, size, level, bucket).

    ``patterns`` has the pattern (a JSON list) of each mark found in several sources; a mark that is not there has
    the pattern of its one source.  ``choice`` has, for each pattern, source and size class, ``base`` (times that all rows are taken),
    ``start`` and ``cut`` (buckets from ``start`` on that are taken once more), and the source's ``source_size`` and ``target``.
    """
    spark = sized.sparkSession
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))  # null comes last
    by_mark = sized.groupBy("mark").agg(F.collect_set(name).alias("names"), F.max("size").alias("size"))
    patterns = written(by_mark.where("size(names) > 1").select("mark", "size", F.to_json(F.array_sort("names")).alias("pattern")), "patterns")
    marked = salted_left_join(sized, patterns.select("mark", "pattern"), ["mark"], 128)
    marked = marked.withColumn("pattern", F.coalesce("pattern", F.to_json(F.array(name))))
    cells = written(marked.groupBy("pattern", "source", "level", "bucket").agg(F.sum("size").alias("size")), "cells")
    # One row for each pattern and source; distinct texts of a single source count each once, too.
    shared = patterns.groupBy("pattern").agg(F.sum("size").alias("words"))
    own = by_mark.where("size(names) = 1").groupBy(F.to_json("names").alias("pattern")).agg(F.sum("size").alias("words"))
    distinct = shared.union(own)
    wide = cells.groupBy("pattern", "source").agg(F.sum("size").alias("size")).join(distinct, "pattern").limit(MOST_CELLS + 1).collect()
    if len(wide) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} pairs of membership pattern and source")
    members: dict = defaultdict(list)
    for r in sorted(wide, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be"))):
        members[r["pattern"]].append(r["source"])
    key = {p: tuple(m) for p, m in members.items()}
    # Two patterns of the same sources are one: names in JSON tell null from text.
    size: dict = defaultdict(int)
    for r in wide:
        size[r["source"]] += r["size"]
    sources = sorted(size, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weights = {s: (weigh or (lambda i, _: WEIGHTS[i % len(WEIGHTS)]))(i, s) for i, s in enumerate(sources)}
    quotas = targets(size, weights, share, repeats) if sources else {}
    flow = min_cost_flow({(key[r["pattern"]], r["source"]): r["size"] for r in wide}, {key[r["pattern"]]: r["words"] for r in wide}, quotas, repeats)

    def cut(alone: bool, debt: dict) -> DataFrame:
        rows = []
        for r in wide:
            if (len(members[r["pattern"]]) == 1) == alone:
                routed = flow.get((key[r["pattern"]], r["source"]), 0.0) + debt.get(r["source"], 0.0)
                routed = min(max(0.0, routed), float(repeats * r["size"]))
                base = min(repeats, int(routed / r["size"] + 1e-9)) if r["size"] else 0
                rows.append((r["pattern"], r["source"], base, float(routed - base * r["size"]) if base < repeats else 0.0))
        # As many rows as were collected.
        routed = local_table(spark, rows, "pattern string, source string, base int, extra double")
        joined = cells.alias("c").join(routed.alias("r"), (F.col("c.pattern") == F.col("r.pattern")) & F.col("c.source").eqNullSafe(F.col("r.source"))).select("c.*", "r.base", "r.extra")
        return written(joined.groupBy("pattern", "source").applyInPandas(_cut_cell, _CHOICE), "choice")

    # Cells of shared texts are cut first; what whole documents miss there, the source's other cell makes up for.
    several = cut(False, {})
    got = {r["source"]: r["got"] for r in several.groupBy("source").agg(F.sum("got").alias("got")).collect()}
    wanted: dict = defaultdict(float)
    for (p, s), words_ in flow.items():
        if len(p) > 1:
            wanted[s] += words_
    choice = several.unionByName(cut(True, {s: wanted[s] - got.get(s, 0) for s in sources}))
    totals = local_table(spark, [(s, int(size[s]), float(quotas[s])) for s in sources], "source string, source_size long, target double")
    choice = choice.alias("c").join(totals.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select("c.*", "t.source_size", "t.target")
    return patterns.select("mark", "pattern"), written(choice, "choice")


_INNER = ("size", "mark", "source", "level", "bucket", "pattern", "base", "start", "cut", "source_size", "target", "cell")


def _planned(docs: DataFrame, narrow: DataFrame) -> tuple[DataFrame, dict]:
    """``docs`` with ``times`` and the columns of the plan, under names that ``docs`` has not; ``narrow`` has doc_id, text and source."""
    same = {c: c for c in _INNER}
    sized = written(units(narrow.select("doc_id", "text", "source"), same).select("source", "mark", "size", "level", "bucket"), "sizes")
    patterns, choice = plan(sized)
    inner = {c: free_name(docs.columns, f"mix_{c}") for c in (*_INNER, "times")}
    own = units(docs, inner)
    own = salted_left_join(own, patterns.toDF(inner["mark"], inner["pattern"]), [inner["mark"]], 128)
    cell = lambda pattern, source, level: F.xxhash64(pattern, source.isNull(), source, level)
    name = F.coalesce(F.concat(F.lit("s"), F.col(inner["source"])), F.lit("t"))
    pattern = F.coalesce(F.col(inner["pattern"]), F.to_json(F.array(name)))
    own = own.withColumn(inner["cell"], cell(pattern, F.col(inner["source"]), F.col(inner["level"])))
    named = choice.select(cell(F.col("pattern"), F.col("source"), F.col("level")).alias(inner["cell"]), *[F.col(c).alias(inner[c]) for c in ("base", "start", "cut", "source_size", "target")])
    own = salted_left_join(own, named, [inner["cell"]], 64)
    return own.withColumn(inner["times"], (F.col(inner["base"]) + (F.pmod(F.col(inner["bucket"]) - F.col(inner["start"]), F.lit(BUCKETS)) < F.col(inner["cut"])).cast("int")).cast("int")), inner


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out, i = _planned(docs, docs)
    size = F.col(i["size"])
    return out.select("doc_id", size.alias("size"), F.col(i["source_size"]).alias("source_size"), F.col(i["target"]).alias("target"), (size * F.col(i["times"])).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept.

    Documents without words are taken once, since they count for no target.
    """
    out, i = _planned(docs, docs)
    copies = F.when(F.col(i["size"]) == 0, 1).otherwise(F.col(i["times"]))
    copy = free_name(out.columns, "mix_copy")
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))).where(F.col(copy) <= copies).select(*docs.columns)
