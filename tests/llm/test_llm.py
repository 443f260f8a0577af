"""Operators of the subpackage against brute force, SQL or exact round trips."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from quillon.llm import components as C
from quillon.llm import html_text, jpeg, line_dedup, mixing, ngram_join, order_minhash, packing, queries, toxicity, url_filter, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, text_hash string"


def frame(spark, rows):
    """Documents, with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x") for i, t, s in rows], SCHEMA)


ODD = [(1, None, "a"), (2, "", None), (3, "word", "a"), (3, "word", "a"), (None, "no id here at all, none", "b"), (5, " \n\t ", "b"), (6, "x" * 200_000, "a"), (7, "tok " * 30_000, None), (8, "É ü ñ \U0001f600 \u00a0 end.", "b")]


@pytest.fixture(scope="module")
def documents(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}


def brute_components(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                r, s = root(a), root(b)
                parent[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_op1_edited_texts_and_equal_prints(spark, small, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op1_order_minhash"](spark, small).collect()}
    ids = sorted(documents, reverse=True)
    for n, i in enumerate(ids):
        t, nxt = documents[i], documents[ids[(n + 1) % len(ids)]]
        half = len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert got[i].n_chars == len(t) and 0 <= got[i].near_next <= 1
    by = defaultdict(set)
    for i in ids:
        by[documents[i]].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by.values())
    long = [r for r in got.values() if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95


def test_op1_order_and_repeats_count(spark):
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    df = spark.createDataFrame([(" ".join(words), " ".join(swapped), " ".join(words) + " " + " ".join(words[:50]))], "a string, b string, c string")
    p = order_minhash.fingerprint
    r = df.select(*[order_minhash.likeness(p(F.col("a")), p(F.col(x))).alias(x) for x in "abc"], order_minhash.likeness(p(F.lit("")), p(F.lit(None).cast("string"))).alias("e")).first()
    assert r.a == 1 and r.e == 1 and r.b < 0.8 and 0.5 < r.c < 1


def textbook_order_minhash(a, b, k=5, draws=400, members=2):
    """Share of agreeing draws with a hash function of its own for each draw."""

    def kmers(text):
        words, seen, out = text.split(), defaultdict(int), []
        for i in range(max(1, len(words) - k + 1)):
            m = " ".join(words[i : i + k])
            out.append((m, seen[m], i))
            seen[m] += 1
        return out

    def draw(rows, j):
        least = sorted(rows, key=lambda r: hashlib.blake2b(f"{j} {r[0]} {r[1]}".encode()).digest())[:members]
        return [r[0] for r in sorted(least, key=lambda r: r[2])]

    x, y = kmers(a), kmers(b)
    return np.mean([draw(x, j) == draw(y, j) for j in range(draws)])


@pytest.mark.parametrize("size", [12, 24, 48, 96, 200, 400])
def test_op1_agrees_with_the_textbook_at_every_length(spark, size):
    pairs = []
    for n in range(60):
        words = [f"w{size}x{n}x{i}" for i in range(size)]
        quarters = [words[i * size // 4 : (i + 1) * size // 4] for i in range(4)]
        pairs.append((" ".join(words), " ".join(sum(quarters[::-1], []))))
    want = np.mean([textbook_order_minhash(*p, draws=64) for p in pairs[:12]])
    p = order_minhash.fingerprint
    got = spark.createDataFrame(pairs, "a string, b string").select(order_minhash.likeness(p(F.col("a")), p(F.col("b"))).alias("x"), F.length(order_minhash.as_string(p(F.col("a")))).alias("n")).collect()
    assert abs(np.mean([r.x for r in got]) - want) < 0.06 and {r.n for r in got} == {64 * 8}


def test_op1_odd_rows(spark):
    rows = order_minhash.with_next(frame(spark, ODD).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ["text"], 4).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r.next_text for r in rows if r.doc_id != 3}
    assert by[8].startswith("tok") and by[5] == "word" and by[1].startswith("no id") and by[None].startswith("É")
    assert order_minhash.with_next(frame(spark, []).select("doc_id", "text"), "doc_id", ["text"], 4).count() == 0


def test_op2_round_trip(spark):
    rows = [(1, "http://a/", "<p>x"), (2, None, "<p>x"), (3, "u\r\nv", None), (4, "b", ""), (4, "b", ""), (None, "n", "<p>x"), (9, "long", "y" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_records(warc.write_archives(pages)).collect()
    assert len(got) == len(rows)
    for r in got:
        html = {i: h for i, _, h in rows}[r.page_id] or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    kind = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert kind == {(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (None, "revisit", 2), (9, "response", None)}
    assert {r.record_type for r in warc.read_records(warc.write_archives(pages, 10)).collect() if r.page_id != 9} == {"response"}
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_op2_pages_table_and_files(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    top = {}
    for i, raw in html.items():
        top[raw] = max(i, top.get(raw, i))
    got = queries.QUERIES["op2_warc"](spark, small).collect()
    want = {(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if top[raw] == i else "revisit", None if top[raw] == i else top[raw]) for i, raw in html.items()}
    assert len(got) == len(html) and {tuple(r) for r in got} == want
    # The archives are files like any other: read back by Spark's own binary source.
    for r in warc.write_archives(pages).collect():
        (tmp_path / r.path).write_bytes(r.content)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    read = warc.read_records(files)
    assert {tuple(r) for r in read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()} == want
    assert warc.checked_revisits(read).count() == 0
    bad = read.withColumn("payload_digest", F.when(F.col("record_type") == "revisit", F.lit("X")).otherwise(F.col("payload_digest")))
    assert warc.checked_revisits(bad).count() == read.where("record_type = 'revisit'").count()


def test_op2_reads_in_linear_time():
    def seconds(n):
        payloads = [os.urandom(1500).hex().encode()] * n
        blob = warc.pack_archive([warc.record_bytes(i, "u", p, warc.digest_of(p), None, False) for i, p in enumerate(payloads)], b"")
        start = time.perf_counter()
        assert sum(1 for _ in warc.read_archive(blob)) == n
        return time.perf_counter() - start

    assert seconds(8000) < 8 * seconds(2000) + 0.5


def test_op2_damage(spark):
    payloads = [os.urandom(20) + b"shared words here " * 200 for _ in range(80)]
    records = [warc.record_bytes(i, "u", p, warc.digest_of(p), None, False) for i, p in enumerate(payloads)]
    dictionary = warc.train_dictionary(payloads)
    blob = warc.pack_archive(records, dictionary)
    assert dictionary and [r.payload for r in warc.read_archive(blob)] == payloads
    for cut in (len(blob) - 3, 5, len(dictionary)):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(blob[:cut]))
    for bad in (records[0][:-1], records[0].replace(b"WARC/1.1", b"WARC/9"), records[0].replace(b"WARC-Date", b"X-Date"), records[0].replace(b"shared", b"sharex", 1)):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)


def test_op3_rules_and_odd_urls(spark, small):
    oracle.same(queries.QUERIES["op3_url_filter"](spark, small), url_filter.ORACLE_SQL, oracle.connection(small))
    urls = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/7x?q", "http://com/en/", "http://xcom/en/", "http://a.example.net/de/81", "http://a.net/DE/", "://net/de/", "http://a.org/es/x", "http://a.org/es", "http://adult-x.example.com/fr", "http://a://b.com/en/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.matched, r.verdict) for r in url_filter.judge(df, url_filter.default_rules()).collect()}
    assert got[0] == got[1] == got[2] == ("", None, "allow")
    assert got[3] == ("www.example.com", "example.com/en/7", "allow") and got[4][1:] == ("com/en/", "block") and got[5][1] is None
    assert got[6][1:] == ("example.net/de/8", "block") and got[7][1] is None and got[8][1:] == ("net/de/", "allow") and got[9][2] == "block" and got[10][1] is None
    assert got[11][2] == "block" and got[12][0] == "a:"
    assert got[11][1] == "pattern:||adult-"
    # Rules without a token are tried on every URL; site rules take hosts in any case; no column name is in the way.
    odd = [url_filter.pattern_rule("*trk"), url_filter.Rule("pattern:all", "block", "^\\S", (), 0), url_filter.host_rule("allow", "XCOM/")]
    got = {r.page_id: (r.matched, r.verdict) for r in url_filter.judge(df, odd).collect()}
    assert got[5] == ("XCOM/", "allow") and got[6] == ("pattern:all", "block") and got[1] == (None, "allow")
    wide = df.selectExpr("*", *[f"page_id AS {c}" for c in ("host", "path", "matched", "verdict", "tokens", "best", "whole", "salt", "rules", "token")])
    same = url_filter.judge(wide, url_filter.default_rules())
    assert same.columns == [*wide.columns, "host_", "path_", "matched_", "verdict_"]
    plain = {r.page_id: (r.host, r.path, r.matched, r.verdict) for r in url_filter.judge(df, url_filter.default_rules()).collect()}
    assert {r.page_id: (r.host_, r.path_, r.matched_, r.verdict_) for r in same.collect()} == plain
    assert all(len({r[c] for c in wide.columns if c != "url"}) == 1 for r in same.collect())
    for text, url, hit in [("||ads.", "my.ads.example/x", 1), ("||ads.", "loads.example/x", 0), ("/ads/*/frame^", "a.b/ADS/1/frame", 1), (".exe|", "a.b/x.exe", 1), (".exe|", "a.b/x.exe/y", 0), ("^pixel.gif|", "a.b/pixel.gif", 1), ("|ads.", "x.ads.b/", 0)]:
        assert bool(re.search(url_filter.pattern_rule(text).pattern, url)) == bool(hit), (text, url)
    assert url_filter.pattern_rule("||ads.").tokens == ("ads",) and url_filter.pattern_rule("/ads/*/frame^").tokens == ("ads", "frame") and url_filter.pattern_rule("||clk*^").tokens == ()
    assert url_filter.judge(df, []).where("verdict <> 'allow'").count() == 0
    assert url_filter.judge(df.limit(0), url_filter.default_rules()).count() == 0


def test_op4_learns_from_bags_and_locates(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        parts = [" ".join(rng.choice(plain) for _ in range(8)) for _ in range(rng.randint(3, 20))]
        y = i % 5 == 0
        if y:
            at = rng.randrange(len(parts))
            parts[at] += rng.choice([" vilename", " vilenamen", " scumbag"])
        rows.append((i, ". ".join(parts) + ".", "s"))
        labels.append((i, 1, int(y)))
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 5 == 0) for i in held]) > 0.97
    found = toxicity.locate(docs, model).collect()
    assert found and np.mean([("vile" in r.sentence or "scum" in r.sentence) for r in found]) > 0.9
    # Ordinary sentences do not add up: a clean text stays, however long; the row cap is one on bytes, not on a text.
    clean = [" ".join(rng.choice(plain) for _ in range(8)) for _ in range(4000)]
    long = frame(spark, [(1, ". ".join(clean * 20), "s"), (2, ". ".join([*clean * 20, "w1 w2 vilename w3"]), "s")])
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.score(long, model).collect()} == {1: False, 2: True}
    assert [r.worst_sentence for r in toxicity.score(long, model).where("n_offending = 1").collect()] == ["w1 w2 vilename w3"]
    few = toxicity.fit(docs, lab, sample_bytes=40_000)
    assert toxicity.score(docs, few).count() == len(rows)
    odd = frame(spark, ODD)
    assert {r.score for r in toxicity.score(odd, model).where("doc_id in (1, 2, 5)").collect()} == {0.0}
    assert toxicity.clean(odd, lab).count() == len(ODD)
    none = toxicity.fit(docs, lab.limit(0))
    assert toxicity.score(docs, none).where("score >= 0.5").count() == 0


def test_op5_matches_sql_and_odd_rows(spark, small):
    oracle.same(queries.QUERIES["op5_line_dedup"](spark, small), line_dedup.ORACLE_SQL, oracle.connection(small))
    rows = [(i, f"own text of document number {i} and more\nshared banner \nend {i}", f"s{i % 6}") for i in range(12)] + ODD
    out = {(r.doc_id, r.text): r for r in line_dedup.remove_boilerplate(frame(spark, rows)).collect()}
    assert out[4, "own text of document number 4 and more\nend 4"].n_removed == 1
    assert out[1, None].n_lines == 0 and out[6, "x" * 200_000].n_removed == 0
    assert line_dedup.remove_boilerplate(frame(spark, rows)).count() == len(rows)
    # Short texts lose a long shared line, too; columns with the names of added and inner ones are kept.
    passage = " ".join(f"shared{i}" for i in range(60))
    wide = frame(spark, [(i, f"{passage}\nown {i}", f"s{i}") for i in range(9)]).selectExpr("*", "doc_id AS n_lines", "doc_id AS n_removed", "doc_id AS text_key", "doc_id AS places", "doc_id AS line", "doc_id AS salt")
    got = line_dedup.remove_boilerplate(wide)
    assert got.columns == [*wide.columns, "n_lines_", "n_removed_"]
    assert all(r.text == f"own {i}" and {r.n_lines, r.n_removed, r.text_key, r.places, r.line, r.salt} == {i} and (r.n_lines_, r.n_removed_) == (2, 1) for r in got.collect() for i in [r.doc_id])
    copies = [(i, "the whole text\nis a copy", f"s{i}") for i in range(8)]
    assert line_dedup.remove_boilerplate(frame(spark, copies)).where("n_removed > 0").count() == 0
    assert line_dedup.remove_boilerplate(frame(spark, [])).count() == 0


def test_pipeline_cuts_boilerplate_at_any_share(spark, small):
    import corpus_pipeline as P

    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"{passage}\nown {i} " + "word " * 38, f"s{i}") for i in range(20)]
    # Exact copies keep their own line, not the passage; what is only copied stays whole.
    rows += [(100 + i, f"a copied line\n{passage}", f"c{i}") for i in range(8)]
    rows += [(200 + i, "the whole text\nis a copy", f"c{i}") for i in range(8)]
    got = {r.doc_id: r.text for r in P.cut_boilerplate(spark, frame(spark, rows), small).collect()}
    assert got == {i: t.replace(passage + "\n", "").replace("\n" + passage, "") for i, t, _ in rows}
    assert got[207] == "the whole text\nis a copy" and got[105] == "a copied line"


def test_pipeline_sends_small_batches_and_starts_no_second_workers(spark, small):
    import corpus_pipeline as P
    import pyarrow as pa

    from quillon.llm.common import BATCH_BYTES, local_table

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for stage in (P.drop_toxic, P.drop_near_copies, P.mix_sources, P.pack_sequences):
            spark.conf.set(key, "64m")
            stage(spark, frame(spark, [(i, f"some text {i}", "a") for i in range(3)]), small)
            wide = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("t"))
            sizes = wide.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
            assert max(r.n for r in sizes) < BATCH_BYTES + 10_000 and sum(r.n for r in sizes) >= 18_000_000
        spark.conf.set(key, "1m")
        P.mix_sources(spark, frame(spark, []), small)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
    rows = [("a", None, 1, 2.5), (None, "\u00e9", -1, 0.0)]
    made = local_table(spark, rows, "p string, s string, n int, x double")
    assert sorted(map(tuple, made.collect()), key=str) == sorted(rows, key=str)
    assert "LocalRelation" in made._jdf.queryExecution().optimizedPlan().toString()
    assert local_table(spark, [], "h long, s string").collect() == []


def test_pipeline_drops_shuffles_and_join_tables(spark, small):
    import glob

    import corpus_pipeline as P

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(40)]
    rows = [(2 * i + c, t + " other end" * c, "a") for i, t in enumerate(words) for c in range(2)]
    folder = spark.conf.get("spark.checkpoint.dir", "").removeprefix("file://")
    try:
        old = set(glob.glob(f"{folder}/quillon-*")) if folder else set()
        spark.conf.set(key, "false")
        kept = P.drop_near_copies(spark, frame(spark, rows), small)
        assert spark.conf.get(key) == "true"
        assert sorted(r.doc_id for r in kept.collect()) == [2 * i for i in range(40)]
        folder = folder or spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
        new = {os.path.basename(f).split("-")[1] for f in set(glob.glob(f"{folder}/quillon-*")) - old}
        assert "links" in new and not new & {"sets", "half", "keys", "known"}
    finally:
        spark.conf.set(key, before)


def check_packed(rows, texts):
    """Pieces cover each text once, ids and places are right; returns the share of padding."""
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    by, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert set(by) == set(texts)
    for i, t in texts.items():
        ids, at = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_op6_exact_cover(spark, small, documents):
    assert check_packed(queries.QUERIES["op6_packing"](spark, small).collect(), documents) < 0.05
    odd = {i: t for i, t, _ in ODD if i != 3} | {10: "Word, word. WORD.. it's <|endoftext|> <|ENDOFTEXT|> don't,", 11: "a." * 50}
    check_packed(packing.pack(frame(spark, [(i, t, "a") for i, t in odd.items()])).collect(), odd)
    assert packing.pack(frame(spark, [])).count() == 0


def test_op6_plain_parts_are_learnt_without_the_whole_tokenizer(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x180)] if c not in (0xD7, 0xF7, 0x130)]
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    plain = " ".join([*(a + b for a in letters for b in letters[::7]), *(f"({a}x{b}{b}" for a in letters for b in signs), "Word,"])
    texts = [plain, "3.14 don't x<|y 'tis", None, "", "### \u0420\u0443\u0441 ###a###"]
    asked, known, encode = [], packing.TokenIds(packing.TOKENIZER), packing.TokenIds._encode
    monkeypatch.setattr(packing.TokenIds, "_encode", lambda self, words: (asked.extend(words), encode(self, words))[1])
    for limit in (known.LIMIT, 50):
        monkeypatch.setattr(packing.TokenIds, "LIMIT", limit)
        monkeypatch.setitem(packing._known, packing.TOKENIZER, known)
        for t, ids in zip(texts, packing.ids_of(pa.array(texts)), strict=True):
            assert ids.tolist() == [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        assert len(known) <= limit
        known.clear()
    odd = {b"", b"3.14", b"don't", b"x<|y", b"'tis", "\u0440\u0443\u0441".encode(), "\u0420\u0443\u0441".encode(), b"###", b"###a###"}
    assert asked and set(asked) <= odd


def test_op6_counts_of_tokens_come_with_the_pieces(spark):
    texts = ["a b b c", "b , c", None, "word " * 3000, "x " * 2047]
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)]).select("doc_id", "text")
    rows = docs.mapInArrow(packing._cut(packing.TOKENIZER), packing._PIECE_SQL + ", rest binary, token long, n long").collect()
    found, want = defaultdict(int), defaultdict(int)
    for r in rows:
        if r.token is not None:
            assert r.doc_id is None and r.rest is None
            found[r.token] += r.n
        elif r.rest is not None:
            ids = np.frombuffer(r.rest, "<u2")
            for t in {*ids.tolist(), -1}:
                want[t] += 1
            want[-2] += len(ids)
    assert found == want and want[-1] == 4


def test_op7_regions():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="nav-open">
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this long and wordy page.</div>
    <article class="post"><h1>Head &amp; line</h1><p>First  <b>para</b>graph&nbsp;one.<br>Same block <a href=x>link</a>.<p>Ok.</p><form>Name <input></form>
    <div class="comments"><p>A reader says a lot of words in this comment here.</p></div><div class="ad">Buy this now please.</div><p>Last 1 &lt; 2.</article>
    <aside><p>Side words that are many and long enough to look like text.</p></aside><footer>&copy; 2024 all rights</footer>"""
    assert html_text.main_text(page) == "Head & line\nFirst paragraph one. Same block link.\nOk.\nLast 1 < 2."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p>") == ""
    plain = "<body><ul><li><a href=1>a</a><li><a href=2>b</a></ul><div>" + "</div><div>".join(["many words of plain text stand here in a row for all to read again and again"] * 3) + "</div></body>"
    assert html_text.main_text(plain).count("\n") == 2 and not html_text.main_text(plain).startswith("a")
    assert html_text.main_text("<" * 2000 + "<p" * 500).count("\n") >= 0


def test_op7_all_rows(spark, small):
    rows = queries.QUERIES["op7_html_text"](spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and r.text for r in rows)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_op8_against_all_pairs(spark, k, percent):
    rng = random.Random(k)
    texts = {}
    for i in range(150):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 5, 12, 40, 120]))]
        texts[len(texts)] = " ".join(words)
        for _ in range(rng.choice([0, 0, 1, 6])):
            near = list(words)
            for _ in range(rng.randrange(4)):
                near[rng.randrange(len(near))] = f"w{rng.randrange(400)}"
            texts[len(texts)] = " ".join(near)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(frame(spark, [(i, t, "a") for i, t in texts.items()]), k, percent, parts=3).collect()}
    assert got == brute_components(texts, k, percent)


def test_op8_table_and_odd_rows(spark, small, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_ngram_join"](spark, small).collect()}
    assert got == brute_components(documents, 3, 90)
    out = ngram_join.ngram_components(frame(spark, ODD), 3, 90).collect()
    assert len(out) == len(ODD) and {(r.doc_id, r.component_id) for r in out if r.doc_id in (1, 2, 3, 5)} == {(1, 1), (2, 2), (3, 3), (5, 5)}
    assert ngram_join.ngram_components(frame(spark, []), 3, 90).count() == 0
    kept = ngram_join.keep_one(frame(spark, ODD))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7, 8] and kept.columns == frame(spark, []).columns


@pytest.mark.parametrize(("nodes", "percent"), [(1024, 90), (7, 90), (5, 50)])
def test_op8_counts_every_link(spark, monkeypatch, nodes, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", nodes)
    rng = random.Random(nodes)
    texts = ["", "one", "one", "only pair here", *["exact copy of a text"] * 4]
    for size, group in [(120, 40), (200, 25), (60, 3), (60, 2), (5, 1)]:
        words = [f"g{group}w{i}" for i in range(size)]
        for _ in range(group):
            near = list(words)
            for _ in range(rng.randrange(3)):
                near[rng.randrange(size)] = f"x{rng.randrange(9999)}"
            texts += [" ".join(near)] * rng.choice([1, 1, 2])
    sets = [{tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))} if (w := t.split()) else set() for t in texts]
    want = {i: sum(j != i and bool(x) and 100 * len(x & y) >= percent * len(x | y) for j, y in enumerate(sets)) for i, x in enumerate(sets)}
    got = {r.doc_id: r.verified_links for r in ngram_join.ngram_components(frame(spark, [(i, t, "a") for i, t in enumerate(texts)]), 3, percent, parts=3).collect()}
    assert got == want and max(want.values()) > 20


def test_op8_fragments_of_long_sets(spark):
    rng = random.Random(4)
    texts = {}
    for size in (510, 530, 1020, 1100, 5000):
        words = [f"l{size}w{i}" for i in range(size)]
        for edits in (0, 1, size // 60, size // 20):
            near = list(words)
            for at in rng.sample(range(size), edits):
                near[at] = f"x{rng.randrange(10**9)}"
            texts[len(texts)] = " ".join(near)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(frame(spark, [(i, t, "a") for i, t in texts.items()]), 3, 90, parts=3).collect()}
    assert got == brute_components(texts, 3, 90) and [ngram_join.level(n) for n in (1, 512, 513, 1024, 1025)] == [0, 0, 1, 1, 2]


def test_op8_hot_groups(spark, monkeypatch):
    """Many nodes in common keys and different components, in several blocks; copies and null texts without number."""
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 16)
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    texts = [None] * 300 + ["one exact copy of a text that is long enough"] * 300
    texts += [" ".join([*passage, *(f"o{i}x{j}" for j in range(rng.randrange(3, 9)))]) for i in range(120)]
    texts += [" ".join([*passage, *(f"n{j}" for j in range(20)), f"e{i}"]) for i in range(80)]
    texts = dict(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(frame(spark, [(i, t, "a") for i, t in texts.items()]), 3, 90, parts=3).collect()}
    assert got == brute_components(texts, 3, 90)
    # Rows of one doc_id with unrelated texts are told apart.
    kept = ngram_join.keep_one(frame(spark, [(1, "a b c d e f g", "s"), (2, "a b c d e f g", "s"), (2, "h i j k l m n o", "s"), (2, "h i j k l m n o", "s"), (3, None, "s")]))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "a b c d e f g"), (2, "h i j k l m n o")] and kept.where("text is null").count() == 1


def test_op8_overlaps_in_column_blocks():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype("u8") for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert ngram_join.overlaps(sets[:12], sets[12:], 7).tolist() == want


@pytest.mark.parametrize("one_task", [0, 1_000_000])
def test_components_of_a_path(spark, one_task):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in C.components(edges, one_task=one_task).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert C.components(edges.where("a < 0"), one_task=one_task).count() == 0


def test_least_nodes_match_union_find():
    rng = np.random.default_rng(3)
    for n, m in ((1, 0), (5, 3), (100, 60), (100, 300), (2000, 1500)):
        u, v = rng.integers(-n, n, (2, m))
        root = {x: x for x in np.concatenate([u, v]).tolist()}

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in zip(u.tolist(), v.tolist(), strict=True):
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
        nodes, least = C.least_nodes(u, v)
        assert nodes.tolist() == sorted(root) and least.tolist() == [top(x) for x in sorted(root)]


def test_op9_round_trip(spark):
    rows = {i: (t or "").encode() for i, t, _ in ODD if i not in (3, None)}
    got = {r.doc_id: r for r in jpeg.read_media(jpeg.encode_texts(frame(spark, ODD))).collect()}
    for i, raw in rows.items():
        p, r = jpeg.pad(raw), got[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(p)) and len(p) % 576 == 0 and len(p) >= 576
        assert r.payload_sha256 == hashlib.sha256(p).hexdigest() and r.tail_crc32 == zlib.crc32(p[-32:])
        image = jpeg.encode([p])[0]
        assert (r.media_bytes, r.media_sha256) == (len(image), hashlib.sha256(image).hexdigest())
        # The thumbnail by hand: one pixel for each 64 bytes, from the first of them.
        thumb = np.clip(np.rint(np.array([jpeg.COEFFICIENTS[p[j]] for j in range(0, len(p), 64)]) / 8 + 128), 0, 255).reshape(-1, 9 * jpeg._shape(len(p))[0])
        assert r.feature == f"{r.width}x{r.height}:{jpeg.thumbnail_hash(thumb)}" and (r.height, r.width) == (8 * thumb.shape[0], 8 * thumb.shape[1])
    assert jpeg.read_media(jpeg.encode_texts(frame(spark, []))).count() == 0


def test_op9_any_bytes_and_damage():
    payloads = [os.urandom(5760), bytes([jpeg.ZERO]) * 576, bytes(range(256)) * 9, jpeg.pad(os.urandom(5_000_000))]
    images = jpeg.encode(payloads)
    frames = list(map(jpeg.parse, images))
    assert [jpeg.payload_of(f, c) for f, c in zip(frames, jpeg.decode(frames), strict=True)] == payloads
    f, c = frames[0], jpeg.decode(frames[:1])[0]
    thumb = jpeg.thumbnail(f, c)
    assert thumb.shape == (f.height // 8, f.width // 8)
    dc = jpeg.COEFFICIENTS[np.frombuffer(payloads[0], np.uint8).reshape(-1, 64)[:, 0]]
    assert (thumb.ravel() == np.clip(np.rint(dc / 8 + 128), 0, 255)).all()
    for i in range(0, len(images[0]), 97):
        try:
            jpeg.decode([jpeg.parse(images[0][:i])])
        except jpeg.JpegError:
            continue
        raise AssertionError(i)


def test_op10_targets_and_flow(spark, small):
    rows = queries.QUERIES["op10_mixing"](spark, small).collect()
    again = queries.QUERIES["op10_mixing"](spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        assert r.taken <= 2 * r.size
        b = by[source[r.doc_id]]
        b[0], b[1], b[2] = b[0] + r.taken, b[1] + r.size, r.target
    assert abs(sum(b[2] for b in by.values()) - 1.5 * sum(b[1] for b in by.values())) < 1e-6
    assert all(abs(t - g) <= 0.02 * g + 20 for t, _, g in by.values())


def test_op10_overlaps_and_odd_rows(spark):
    assert mixing.targets({"a": 10, "b": 100, None: 50}, {"a": 5, "b": 2, None: 1}) == {"a": 20, "b": 220 * 2 / 3, None: 220 / 3}
    cells = {(("a",), "a"): 10, (("a", "b"), "a"): 10, (("a", "b"), "b"): 10, (("b",), "b"): 5}
    flow = mixing.min_cost_flow(cells, {("a",): 10, ("a", "b"): 10, ("b",): 5}, {"a": 15, "b": 12})
    into = {x: sum(v for (_, s), v in flow.items() if s == x) for x in "ab"}
    assert abs(into["a"] - 15) < 1e-6 and abs(into["b"] - 12) < 1e-6
    # 27 words of 25 distinct ones: two are used again, and no more.
    uses = {p: sum(v for (q, _), v in flow.items() if q == p) for p in [("a",), ("a", "b"), ("b",)]}
    assert abs(sum(max(0, uses[p] - n) for p, n in zip(uses, (10, 10, 5), strict=True)) - 2) < 1e-6
    out = mixing.mix(frame(spark, ODD))
    assert out.columns == frame(spark, []).columns and out.where("text = ''").count() == 1
    assert mixing.mix(frame(spark, [])).count() == 0
    # Columns with inner names keep their values.
    plain = frame(spark, ODD).drop("size")
    names = [f"{p}{c}" for p in ("", "mix_") for c in ("size", "mark", "level", "bucket", "pattern", "base", "cut", "source_size", "target", "cell", "times", "copy")] + ["salt", "memberships", "class"]
    wide = mixing.mix(plain.selectExpr("*", *[f"crc32(coalesce(text, '')) AS {c}" for c in names]))
    assert all(len({r[c] for c in names}) == 1 and r.size == zlib.crc32((r.text or "").encode()) for r in wide.collect())
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    assert sorted(map(key, wide.collect())) == sorted(map(key, mixing.mix(plain).collect()))


def brute_flow_cost(cells, distinct, quotas, repeats):
    """Most words and their least cost, by unit augmentation over all residual paths (Bellman-Ford)."""
    edges = []

    def add(a, b, room, cost):
        edges.append([a, b, room, cost, len(edges) + 1])
        edges.append([b, a, 0, -cost, len(edges) - 1])

    for (p, s), n in cells.items():
        add(p, ("s", s), repeats * n, 0)
    for p, n in distinct.items():
        for use in range(12):
            add("start", p, n, min(use, 2 * repeats))
    for s, q in quotas.items():
        add(("s", s), "stop", q, 0)
    words = cost = 0
    while True:
        far, via = {"start": 0}, {}
        for _ in range(40):
            for i, (a, b, room, c, _) in enumerate(edges):
                if room > 0 and a in far and far[a] + c < far.get(b, 10**9):
                    far[b], via[b] = far[a] + c, i
        if "stop" not in far:
            return words, cost
        at = "stop"
        while at != "start":
            e = edges[via[at]]
            e[2] -= 1
            edges[e[4]][2] += 1
            at = e[0]
        words, cost = words + 1, cost + far["stop"]


@pytest.mark.parametrize("seed", range(6))
def test_op10_flow_against_brute_force(seed):
    rng = random.Random(seed)
    sources = "abcd"[: rng.randrange(2, 5)]
    distinct, cells = {}, {}
    for _ in range(rng.randrange(2, 7)):
        p = tuple(sorted(rng.sample(sources, rng.randrange(1, len(sources) + 1))))
        distinct[p] = rng.randrange(1, 8)
        for s in p:
            cells[p, s] = distinct[p] * rng.randrange(1, 3)
    quotas = {s: rng.randrange(1, 25) for s in sources}
    flow = mixing.min_cost_flow(cells, distinct, quotas)
    used = {p: sum(v for (q, _), v in flow.items() if q == p) for p in distinct}
    cost = sum(sum(max(0.0, min(used[p] - k * n, n if k < 4 else 1e9)) * k for k in range(5)) for p, n in distinct.items())
    want = brute_flow_cost(cells, distinct, quotas, 2)
    assert abs(sum(flow.values()) - want[0]) < 1e-6 and abs(cost - want[1]) < 1e-6
    assert all(v <= 2 * cells[k] + 1e-6 for k, v in flow.items())


def test_op10_shared_texts_are_routed(spark):
    """A text of two sources is one pattern: its words are not repeated while others are unused."""
    rows = [(i, f"own a {i} " * 20, "a") for i in range(40)] + [(100 + i, f"both {i} " * 30, s) for i in range(40) for s in "ab"] + [(300 + i, f"own b {i} " * 20, "b") for i in range(40)]
    docs = frame(spark, rows).select("doc_id", "text", "source")
    out, names = mixing._planned(docs, docs)
    got = out.select(F.col(names["pattern"]).alias("p"), F.col(names["size"]).alias("n"), F.col(names["times"]).alias("t"), F.col(names["target"]).alias("g"), "source").collect()
    assert {r.p for r in got if r.p} == {'["sa","sb"]'}
    for s in "ab":
        assert abs(sum(r.n * r.t for r in got if r.source == s) - next(r.g for r in got if r.source == s)) < 200


def test_pipeline_stages(spark, small):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    clean = P.drop_toxic(spark, docs, small)
    score = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, s in score.items() if s < 0.5)
    kept = P.drop_near_copies(spark, docs, small).select("doc_id").collect()
    groups = brute_components({r.doc_id: r.text for r in docs.collect()}, 5, 80)
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (_, c) in groups.items() if c == i)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns, name
    out = P.run(spark, small)
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "start", "length", "sequence_id"}


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert [f"op{i}" for i in range(1, 11)] + ["pipeline"] == [n.split("_")[0] for n in queries.QUERIES]
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
