"""SimHash fingerprints and the search for all within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import words_of

BITS = 64
RADIUS = 3
BLOCKS = 6
#: A term weighs as much as its letters, up to this.
MOST_WEIGHT = 15
#: Terms whose votes are counted together: weight x terms must stay below 2**15.
_TOGETHER = 2048
_LANES = 0x0001000100010001
#: Documents that one task of the neighbour window holds, about.
ROWS_PER_RANGE = 8_000
#: Ranges at most; their edges, 8 bytes each, are part of the plan. Ranges of more rows sort on disk.
MOST_RANGES = 100_000
#: Rows whose id is divisible by this ask for their neighbours.
ASKED_EVERY = 100


def simhash(text: Column) -> Column:
    """The 64-bit fingerprint of a text, as SQL functions only.

    Terms are pairs of neighbouring words (the word itself if there is one only) and weigh by
    their letters, so pairs of short common words count little. Each bit of a term's hash
    votes for that bit of the fingerprint; a bit is set when more than half of the weight wants it.
    Four votes are counted in one addition: bits k, k+16, k+32 and k+48 of the hash in 16-bit
    lanes of one number. Without words the fingerprint is 0.
    """
    return F.transform(F.array(words_of(text)), _of_words)[0]


def _of_words(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))

    def term(a: Column, b: Column) -> Column:
        weight = F.least(F.octet_length(a) + F.octet_length(b), F.lit(MOST_WEIGHT)).cast("long")
        return F.struct(F.xxhash64(a, b).alias("h"), weight.alias("w"))

    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), term)
    alone = F.transform(words, lambda a: F.struct(F.xxhash64(a).alias("h"), F.lit(1).cast("long").alias("w")))
    terms = F.when(F.size(words) > 1, pairs).otherwise(alone)
    return F.transform(F.array(terms), _of_terms)[0]


def _of_terms(terms: Column) -> Column:
    zero = F.lit(0).cast("long")
    none = F.struct(*[zero.alias(f"v{k}") for k in range(16)], zero.alias("all"))

    def vote(acc: Column, t: Column) -> Column:
        return F.struct(*[
            (acc[f"v{k}"] + F.shiftrightunsigned(t["h"], k).bitwiseAND(F.lit(_LANES)) * t["w"]).alias(f"v{k}")
            for k in range(16)], (acc["all"] + t["w"]).alias("all"))

    def lanes(v: Column) -> Column:
        sums = [F.shiftrightunsigned(v[f"v{k}"], 16 * lane).bitwiseAND(F.lit(0xFFFF))
                for lane in range(4) for k in range(16)]
        return F.array(*sums, v["all"])

    def chunk(acc: Column, i: Column) -> Column:
        part = F.aggregate(F.slice(terms, i * _TOGETHER + 1, F.lit(_TOGETHER)), none, vote, lanes)
        return F.zip_with(acc, part, lambda a, b: a + b)

    chunks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(terms) - 1, F.lit(0)) / _TOGETHER).cast("int"))
    votes = F.aggregate(chunks, F.array_repeat(zero, BITS + 1), chunk)
    return F.transform(F.array(votes), lambda v: F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)), zero,
        lambda acc, j: F.when(2 * F.get(v, j) > F.get(v, F.lit(BITS)),
                              F.expr("1L") * acc.bitwiseOR(F.call_function("shiftleft", F.expr("1L"), j)))
        .otherwise(acc)))[0]


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each row; a null text is an empty one."""
    return docs.select(col(id_col).alias("doc_id"), simhash(col(text_col)).alias("fingerprint"))


def _tables(fingerprint: Column, blocks: int, radius: int) -> Column:
    """One (table, key) per choice of blocks that must agree; the other blocks are masked out."""
    width = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    start = [sum(width[:i]) for i in range(blocks)]
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << width[i]) - 1) << start[i] for i in chosen)
        mask -= (mask >> (BITS - 1)) << BITS
        keys.append(F.struct(F.lit(t).alias("t"), fingerprint.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All (query, fingerprint) within ``radius`` bits, for distinct fingerprints of both sides.

    Both have a column ``fingerprint``. Of ``blocks`` blocks, ``radius`` differing bits touch at
    most ``radius``, so the others agree: one table for each choice of those, keyed by the agreeing
    bits, finds every pair, and the full distance is checked. A pair is taken from the first table
    that has it, so no pair comes twice. Null fingerprints match nothing.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be below blocks")

    def table(df: DataFrame, name: str) -> DataFrame:
        one = df.select(col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return one.select(name, F.explode(_tables(F.col(name), blocks, radius)).alias("_k")).select(
            name, F.col("_k.t").alias("_t"), F.col("_k.key").alias("_key"))

    pairs = table(queries, "query").join(table(index, "fingerprint"), ["_t", "_key"])
    first = F.array_min(F.transform(F.filter(F.arrays_zip(
        _tables(F.col("query"), blocks, radius).alias("a"), _tables(F.col("fingerprint"), blocks, radius).alias("b")),
        lambda z: z["a"] == z["b"]), lambda z: z["a"]["t"]))
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint"))).alias("distance")
    return pairs.where(near <= radius).where(F.col("_t") == first).select("query", "fingerprint", near)


def count_within(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """fingerprint (distinct, of the queries) and n_near: rows of the index within ``radius`` bits of it.

    Equal fingerprints of the index are folded to one with a count, so a group of copies is one entry of
    each table. Null fingerprints neither ask nor count.
    """
    folded = index.groupBy(col("fingerprint").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    pairs = within_radius(queries, index, radius, blocks)
    return pairs.join(folded, F.col("fingerprint") == F.col("_at")).groupBy(F.col("query").alias("fingerprint")).agg(
        F.sum("_n").alias("n_near"))


def _numbers(values: list, kind: str) -> Column:
    """A constant array as one literal of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _above(edges: list[int], value: Column) -> Column:
    """How many of the edges, which fall, lie above the value; a binary search."""
    if not edges:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(edges).bit_length()))]
    table = _numbers(edges, "bigint")
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: F.when(F.get(table, at + s - 1) > value, at + s).otherwise(at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, text, fingerprint and the text and fingerprint of the next row by descending id.

    After the last comes the first again. Null ids come last; rows with one id follow each other by a hash of
    the text, then by the text. Ids are cut into ranges, MOST_RANGES at most, and each range gets a copy of
    the next range's first row, so the window stays inside a range and text is shuffled once. An
    id that many rows share, and null, has ranges of its own, cut by the hash. Only equal rows cannot be told apart.
    """
    own = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("_hash", F.xxhash64("text"))
    ranges = min(own.count() // rows_per_range + 1, MOST_RANGES)
    edges, hot = [], []
    if ranges > 1:
        shares = _numbers([i / ranges for i in range(1, ranges)], "double")
        cuts = own.agg(F.percentile_approx("doc_id", shares, min(10 * ranges + 1_000, 1_000_000)).alias("q")).first()["q"]
        # At most rows / rows_per_range ids can be so frequent.
        hot = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_range).collect()
        alone = [r["doc_id"] for r in hot if r["doc_id"] is not None]
        beyond = [d + 1 for d in alone if d < (1 << 63) - 1]
        edges = sorted({*(cuts or []), *alone, *beyond}, reverse=True)
    part = F.lit(0).cast("long")
    for n in sorted({_bits(r["_n"], rows_per_range) for r in hot}):
        ids = [r["doc_id"] for r in hot if _bits(r["_n"], rows_per_range) == n]
        known = [d for d in ids if d is not None]
        here = F.col("doc_id").isNull() if None in ids else F.lit(False)
        if known:
            here = here | F.coalesce(F.array_contains(_numbers(known, "bigint"), F.col("doc_id")), F.lit(False))
        part = F.when(here, F.shiftright(F.col("_hash"), 64 - n)).otherwise(part)
    # Null comes after the ids below all edges.
    at = F.coalesce(_above(edges, F.col("doc_id")), F.lit(0))
    ranged = own.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(len(edges) + 1)).otherwise(at)) \
        .withColumn("_part", part)
    # One short row per range, as many as MOST_RANGES and the ranges of hot ids: one task orders them.
    first = F.min(F.struct((-F.col("doc_id")).alias("down"), "doc_id", "_hash")).alias("_head")
    heads = ranged.groupBy("_range", "_part").agg(first).select("_range", "_part", "_head.doc_id", "_head._hash")
    order = Window.orderBy("_range", "_part")
    last = Window.orderBy(F.desc("_range"), F.desc("_part"))
    sent = heads.select(
        F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"),
        F.coalesce(F.lag("_range").over(order), F.first("_range").over(last)).alias("_to"),
        F.coalesce(F.lag("_part").over(order), F.first("_part").over(last)).alias("_to_part"))
    copies = ranged.join(F.broadcast(sent), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))) \
        .groupBy("doc_id", "_hash", "_to", "_to_part").agg(F.max("text").alias("text")) \
        .select("doc_id", "text", "_hash", F.col("_to").alias("_range"), F.col("_to_part").alias("_part"), F.lit(1).alias("_copy"))
    both = ranged.withColumn("_copy", F.lit(0)).unionByName(copies)
    both = both.withColumn("fingerprint", simhash(F.col("text")))
    w = Window.partitionBy("_range", "_part").orderBy("_copy", F.col("doc_id").desc_nulls_last(), "_hash", F.col("text").desc())
    return both.select("doc_id", "text", "_copy", "fingerprint", F.lead("text").over(w).alias("next_text"),
                       F.lead("fingerprint").over(w).alias("next_fingerprint")) \
        .where(F.col("_copy") == 0).drop("_copy")


def _bits(rows: int, rows_per_range: int) -> int:
    """Leading bits of a hash that cut so many rows into ranges."""
    return max(1, (rows // rows_per_range).bit_length())


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """How far fingerprints follow an edit: each text against its half-replaced form and the next text.

    The last floor(n / 2) of n code points give way to as many from the start of the next
    document (or all of it). Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, bits (the fingerprint as a number). Null and empty texts have fingerprint 0; one row is next to itself.
    """
    rows = with_next(docs, id_col, text_col, rows_per_range)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    made = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("_edited"), "fingerprint",
                       "next_fingerprint")
    made = made.select("*", F.sha2("_edited", 256).alias("edited_sha256"),
                       simhash(F.col("_edited")).alias("_edited_fp"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("_edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("_edited_fp")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.col("fingerprint").alias("bits"))


def likeness_and_neighbours(docs: DataFrame, asked_every: int = ASKED_EVERY, radius: int = RADIUS, blocks: int = BLOCKS,
                            id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows of :func:`edit_likeness` without ``bits``, and how many rows lie near those that ask.

    Rows whose id is divisible by ``asked_every`` ask: ``n_near`` counts the rows, the asking one included, whose
    fingerprint is within ``radius`` bits. It is null for all other rows, null ids too. The short rows are
    stored, so fingerprints are worked out once.
    """
    rows = cut_lineage(edit_likeness(docs, id_col, text_col, rows_per_range))
    asks = F.coalesce(F.col("doc_id") % asked_every == 0, F.lit(False))
    asked = rows.where(asks)
    found = count_within(asked.select(F.col("bits").alias("fingerprint")), rows.select(F.col("bits").alias("fingerprint")),
                         radius, blocks).select(F.col("fingerprint").alias("_bits"), "n_near")
    # Rows that do not ask take no part in the join, where they would share one key.
    answered = asked.join(found, F.col("bits") == F.col("_bits"), "left").drop("_bits")
    others = rows.where(~asks).withColumn("n_near", F.lit(None).cast("long"))
    return answered.unionByName(others).drop("bits")
