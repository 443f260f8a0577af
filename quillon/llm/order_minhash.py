"""Order MinHash document fingerprints, with DataFrame functions only.

k-mers are runs of ``k`` words.  Every k-mer carries its occurrence number, so repeats count.
Each of ``draws`` orders of all (k-mer, occurrence) selects the ``tuple_size`` least; they are put in
text order, and the tuple of their k-mers is hashed.  Two texts agree in a draw only if the selected
k-mers and their order agree, which falls with the edit distance.

The orders come from one hash: its upper bits name a place on a circle of ``draws`` places, and order j
goes by the distance round the circle from place j, then by the rest of the hash.  Each single order is
that of random values, as with a hash function of its own, at every length of text: a text with few k-mers
is no special case, its least k-mers are merely found at more distant places.  The orders depend on one
another (texts of few k-mers repeat tuples), which widens the spread of a likeness and moves no mean.

A text of fewer than k words (but some) has one k-mer, the whole sequence, and its tuples have that
one member; null and empty texts have no k-mer, and their fingerprints are empty and equal.  Equal texts
have equal fingerprints.  Positions have 31 bits, as many as arrays have entries; hashes of k-mers 33.
Rows with the same id are told apart by their texts; a null id comes below all others.  Extra columns are
ignored by the query; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 5
#: Orders, a power of two.
DRAWS = 64
TUPLE = 2
#: Bits of a packed k-mer: hash above, position below.
POSITION_BITS = 31


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pack(value: Column, position: Column) -> Column:
    return value.bitwiseAND(F.lit(-(1 << POSITION_BITS))).bitwiseOR(position.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))


def _kmer_positions(text: Column, k: int) -> Column:
    """Sorted packed longs, one per k-mer: its hash, and below it its position."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))

    def kmers(h: Column) -> Column:
        count = F.greatest(F.size(h) - (k - 1), F.least(F.size(h), F.lit(1)))
        return F.transform(F.slice(h, 1, count), lambda x, i: _pack(F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]), i.cast("long")))

    return F.sort_array(_let(F.transform(words, lambda w: F.xxhash64(w)), kmers))


def _numbered(s: Column) -> Column:
    """Sorted packed longs of (k-mer, occurrence number) from sorted packed k-mers.

    Equal k-mers are neighbours in text order, so the place within a run is the number.  The
    first occurrence keeps the hash of its k-mer, so a text without repeats stays as it is.
    """

    def entry(x: Column, occurrence: Column) -> Column:
        return F.when(occurrence == 0, x).otherwise(_pack(F.xxhash64(F.shiftright(x, POSITION_BITS), occurrence), x))

    def starts(x: Column, i: Column) -> Column:
        return (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(s, i - 1)), POSITION_BITS) != 0)

    def runs(h: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            stop = F.coalesce(F.get(h, j + 1), F.size(s))
            return F.transform(F.slice(s, start + 1, stop - start), entry)

        return F.flatten(F.transform(h, run))

    single = F.size(F.filter(s, starts)) == F.size(s)
    heads = F.filter(F.transform(s, lambda x, i: F.when(starts(x, i), i).otherwise(F.lit(-1))), lambda i: i >= 0)
    return F.when(single, s).otherwise(F.sort_array(_let(heads, runs)))


def fingerprint(text: Column, k: int = K, draws: int = DRAWS, tuple_size: int = TUPLE) -> Column:
    """Array of longs, one for each draw (none without k-mers): the draw, and below it 32 bits of hash."""
    bits = draws.bit_length() - 1

    def place(x: Column) -> Column:
        # Longs are sorted with their sign, so the circle starts at the negative ones.
        return F.shiftright(x, 64 - bits) + F.lit(draws // 2)

    def select(s: Column) -> Column:
        # Sorted by place and hash.  What comes after `tuple_size` others of its place is in no tuple.
        least = F.filter(s, lambda x, i: (i < tuple_size) | (place(F.get(s, i - tuple_size)) != place(x)))

        def tuples(c: Column) -> Column:
            members = F.least(F.lit(tuple_size), F.size(c))

            def at(i: Column) -> Column:
                chosen = F.transform(F.sequence(F.lit(0), members - 1), lambda d: F.get(c, (i + d) % F.size(c)))
                # Position above, hash below: sorting restores the text order.
                placed = F.sort_array(F.transform(chosen, lambda y: F.shiftleft(y, 64 - POSITION_BITS).bitwiseOR(F.shiftrightunsigned(y, POSITION_BITS))))
                value = F.xxhash64(F.transform(placed, lambda y: y.bitwiseAND(F.lit((1 << (64 - POSITION_BITS)) - 1))))
                return value.bitwiseAND(F.lit(0xFFFFFFFF))

            # The first of a place serves the draws from behind the place before it up to its own; draws
            # behind the last place go round to the first.
            def served(x: Column, i: Column) -> Column:
                before = F.when(i == 0, F.lit(-1)).otherwise(place(F.get(c, i - 1)))
                many = (place(x) - before).cast("int")
                return F.when(many > 0, F.array_repeat(at(i), many)).otherwise(F.array().cast("array<bigint>"))

            rest = F.array_repeat(at(F.lit(0)), (F.lit(draws - 1) - place(F.get(c, F.size(c) - 1))).cast("int"))
            drawn = F.concat(F.flatten(F.transform(c, served)), rest)
            return F.when(F.size(c) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(drawn, lambda v, j: F.shiftleft(j.cast("long"), 32).bitwiseOR(v)))

        return _let(least, tuples)

    return _let(_let(_kmer_positions(text, k), _numbered), select)


def as_string(print_: Column) -> Column:
    """Eight hex digits for each draw; empty without k-mers."""
    return F.array_join(F.transform(print_, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of draws in which two fingerprints agree; 1 for two empty ones, 0 if one is."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / most)


def with_next(docs: DataFrame, id_col: str, carried: list[str], buckets: int) -> DataFrame:
    """Add ``next_<c>`` for each carried column: the value of the next row by descending id.

    The last row gets the first one's.  Rows are dealt by ranges of ids that are bounded by
    quantiles; the first row of each range is also sent, as a guest, to the range before it.
    Equal ids are ordered by a hash of the carried columns; null ids come last.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    tie = F.xxhash64(*carried)
    keyed = docs.withColumn("_key", key)
    cuts = sorted(set(keyed.select(F.col("_key").cast("double").alias("q")).approxQuantile("q", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)))) if buckets > 1 else []
    bucket = F.lit(0)
    if cuts:
        bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_key").cast("double")))
    keyed = keyed.withColumn("_bucket", bucket)
    # One row per range: at most `buckets` of them.
    tops = sorted((r["_bucket"], r["top"]) for r in keyed.groupBy("_bucket").agg(F.max("_key").alias("top")).collect())
    if not tops:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    to = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    sent = docs.where(F.coalesce(F.col(id_col).isin([t for t in to if t != -(1 << 63)]), F.lit(False)) if -(1 << 63) not in to else (F.col(id_col).isin(list(to)) | F.col(id_col).isNull())).withColumn("_key", key)
    target = F.create_map(*[F.lit(x) for pair in to.items() for x in (pair[0], pair[1])])
    guests = sent.withColumn("_bucket", F.get(F.array(F.element_at(target, F.col("_key"))), F.lit(0)).cast("int")).withColumn("_guest", F.lit(1))
    # The guest of the lowest range is the first row of all, which follows the last one.
    both = keyed.withColumn("_guest", F.lit(0)).unionByName(guests)
    order = Window.partitionBy("_bucket").orderBy(F.col("_guest"), F.col("_key").desc(), tie)
    ahead = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried], F.lead(F.lit(1)).over(order).alias("_has"))
    return ahead.where("_guest = 0").drop("_key", "_bucket", "_guest", "_has")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    The edited text ends in as many code points of the next document (descending doc_id) as
    half the text has.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = docs.withColumn("print", fingerprint(F.col("text")))
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(marked, "doc_id", ["text", "print"], buckets)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "print", "next_print", edited.alias("edited"))
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("print")).alias("fingerprint"),
        as_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
