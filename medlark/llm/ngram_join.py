"""Join of documents by the Jaccard similarity of their word shingles, with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import Words, slices, spread, trimmed, trimmed_stream
from medlark.llm.components import components
from medlark.llm.exchange import ROW, buckets_for, gather, mix, parts_for, place, shared_keys

SHINGLE = 5
#: Two sets link when 100 x intersection is at least so much x union.
PERCENT = 75
#: Shingles and documents that a task of the tree join holds, about; larger clusters go block by block.
BLOCK_SHINGLES = 1_000_000
BLOCK_DOCUMENTS = 2_000
#: Documents of a leaf of a signature tree, and bits of a bitmap at most.
LEAF = 8
MOST_BITS = 1 << 14
#: Ids are broadcast up to so many, else joined by a shuffle.
MOST_BROADCAST = 2_000_000
_BYTES_PER_WORD = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, 64-bit shingle) pairs in order. A text of fewer words is one shingle, an empty one none."""
    words = Words(texts, fold=True)
    digest = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words.vocabulary)) or b"", np.uint64)
    h = digest[words.ids]
    n = np.diff(words.offsets)
    full = np.maximum(n - size + 1, 0)
    starts = spread(words.offsets[:-1], full)
    key = np.full(len(starts), np.uint64(size))
    for i in range(size):
        key = mix(key * _ODD + h[starts + i])
    text = np.repeat(np.arange(len(n)), full)
    short = np.flatnonzero((n > 0) & (n < size))
    rest = n[short].astype(np.uint64)
    for i in range(size - 1):
        has = n[short] > i
        rest[has] = mix(rest[has] * _ODD + h[words.offsets[short[has]] + i])
    text, key = np.append(text, short), np.append(key, rest)
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    fresh = np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1])) if len(text) else np.zeros(0, bool)
    return text[fresh], key[fresh]


def classes(own: DataFrame, size: int) -> DataFrame:
    """doc_id, n and a 128-bit hash of the set of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                text, key = shingles(b.column(1).slice(lo, hi - lo), size)
                cuts = np.searchsorted(text, np.arange(hi - lo + 1))
                sums = [np.append(np.uint64(0), np.cumsum(mix(key ^ np.uint64(s)), dtype=np.uint64)) for s in (1, 2)]
                one, two = (s[cuts[1:]] - s[cuts[:-1]] for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(cuts), pa.int64()), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64))], names=["doc_id", "n", "one", "two"])

    return own.mapInArrow(trimmed_stream(run), "doc_id long, n long, one long, two long")


def with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on doc_id with a stored list of ids; broadcast only if it is counted to be short."""
    return docs.join(F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids, "doc_id", how)


class _Forest:
    """Union of sets of numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def union(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)

    def labels(self) -> np.ndarray:
        up = self.up
        while True:
            above = up[up]
            if (above == up).all():
                return up
            up[:] = above


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct sets are similar enough."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def tree_components(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each of some sorted sets the number of the first set it is linked with, itself included.

    Sets are put in order of their smallest hashes, so that similar ones share leaves of a binary tree. A
    node has the OR of its sets' bitmaps, the range of their sizes, and how many elements share a
    bit at most. Two nodes are visited together from the root down. A pair is left when the sizes are too far
    apart, when even all common bits cannot make the overlap that the smallest sizes need, or
    when all sets of both are linked already. Pairs of sets that remain are compared in full.
    """
    n = len(sets)
    if n < 2:
        return np.arange(n)
    size = np.array([len(s) for s in sets])
    bits = 64
    while bits < MOST_BITS and bits < 8 * size.mean():
        bits *= 2
    order = np.lexsort((size, [mix(s).min() if len(s) else np.uint64(0) for s in sets]))
    width = 1 << max(0, int(np.ceil(np.log2(-(-n // LEAF)))))
    maps = np.zeros((width * LEAF, bits // 64), np.uint64)
    for row, i in enumerate(order):
        bit = (sets[i] % np.uint64(bits)).astype(np.int64)
        np.bitwise_or.at(maps[row], bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64))
    total = width * LEAF
    least, most = np.full(total, 1 << 40), np.zeros(total, np.int64)
    least[:n] = most[:n] = size[order]
    extra = np.zeros(total, np.int64)
    extra[:n] = size[order] - np.bitwise_count(maps[:n]).sum(1)
    levels = [(maps, least, most, extra)]

    def joined(step: int) -> tuple[np.ndarray, ...]:
        m, lo, hi, ex = levels[-1]
        return (np.bitwise_or.reduce(m.reshape(-1, step, m.shape[1]), 1), lo.reshape(-1, step).min(1),
                hi.reshape(-1, step).max(1), ex.reshape(-1, step).max(1))

    levels.append(joined(LEAF))
    while len(levels[-1][1]) > 1:
        levels.append(joined(2))

    forest = _Forest(n)
    label = np.arange(total)

    def possible(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        m, lo, hi, ex = levels[level]
        ok = (100 * hi[a] >= percent * lo[b]) & (100 * hi[b] >= percent * lo[a])
        a, b, at = a[ok], b[ok], np.flatnonzero(ok)
        overlap = np.bitwise_count(m[a] & m[b]).sum(1).astype(np.int64) + np.minimum(ex[a], ex[b])
        overlap = np.minimum(overlap, np.minimum(hi[a], hi[b]))
        # overlap / union >= p with union = a + b - overlap, for the smallest sizes.
        return at[(100 + percent) * overlap >= percent * (lo[a] + lo[b])]

    def uniform(level: int) -> np.ndarray:
        """One label of all sets of a node, or -1."""
        step = total // len(levels[level][1])
        own = label.reshape(-1, step)
        real = (np.arange(total) < n).reshape(-1, step)
        low = np.where(real, own, 1 << 40).min(1)
        high = np.where(real, own, -1).max(1)
        return np.where(low == high, low, -1)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        """Compare the sets of leaf pairs; those linked by now are skipped."""
        within = np.arange(LEAF)
        i = (a[:, None, None] * LEAF + within[:, None]).repeat(LEAF, 2).ravel()
        j = (b[:, None, None] * LEAF + within).repeat(LEAF, 1).ravel()
        ok = (i < j) & (j < n) & (i < n)
        i, j = i[ok], j[ok]
        ok = label[i] != label[j]
        i, j = i[ok], j[ok]
        for at in possible(0, i, j):
            x, y = int(i[at]), int(j[at])
            if forest.find(x) != forest.find(y) and _links(sets[order[x]], sets[order[y]], percent):
                forest.union(x, y)
        label[:n] = forest.labels()

    def visit(level: int, a: np.ndarray, b: np.ndarray) -> None:
        own = uniform(level)
        ok = (own[a] < 0) | (own[a] != own[b])
        a, b = a[ok], b[ok]
        keep = possible(level, a, b)
        a, b = a[keep], b[keep]
        if level == 1:
            near = np.argsort(b - a, kind="stable")
            at, step = 0, 64
            while at < len(near):
                part = near[at: at + step]
                own = uniform(1)
                part = part[(own[a[part]] < 0) | (own[a[part]] != own[b[part]])]
                compare(a[part], b[part])
                at, step = at + step, min(4096, step * 2)
            return
        pairs = [(2 * a + i, 2 * b + j) for i in (0, 1) for j in (0, 1)]
        a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        ok = a <= b
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 50_000):
            visit(level - 1, a[at: at + 50_000], b[at: at + 50_000])

    root = np.zeros(1, np.int64)
    visit(len(levels) - 1, root, root)
    first = np.full(n, n)
    np.minimum.at(first, label[:n], order)
    out = np.empty(n, np.int64)
    out[order] = first[label[:n]]
    return out


def join_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
    block_shingles: int = BLOCK_SHINGLES, block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """Components of documents whose sets of word shingles link; exact, without caps.

    1. Equal sets become one class. 2. A set can only link if ``percent`` of its shingles stand in some other
    set, so shingles are exchanged once and all other sets are out. 3. Sets that link share one of their rarest
    (100 - percent) % shingles, so these route the rest into clusters. 4. In each cluster a signature tree is joined
    with itself. Clusters too large for a task are cut into blocks, and every two blocks meet.

    Returns doc_id, n_shingles, component_id. Texts without words have no set and are linked with nothing.
    A null id is linked with nothing and has no component. Rows that share an id are one node. Other columns
    are ignored.
    """
    own = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    sets = cut_lineage(classes(own, size))
    rows = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    firsts = cut_lineage(rows.groupBy("n", "one", "two").agg(F.min("doc_id").alias("first")))
    total, count = firsts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts, buckets = parts_for(total), buckets_for(count)

    def pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for lo, hi in slices(batch.column(1)):
            text, key = shingles(batch.column(1).slice(lo, hi - lo), size)
            yield batch.column(0).slice(lo, hi - lo).to_numpy()[text], place(key, parts), hi - lo

    lead = firsts.select(F.col("first").alias("doc_id")).distinct()
    others = cut_lineage(rows.select("doc_id").distinct().join(lead, "doc_id", "left_anti"))
    reps = with_ids(own.where(F.col("doc_id").isNotNull()), others, "left_anti")
    sent = reps.mapInArrow(lambda batches: gather(batches, pairs), ROW)
    shared = shared_keys(sent, buckets, only_number=True).select("doc_id", F.col("n").alias("shared"))
    smallest = firsts.groupBy(F.col("first").alias("doc_id")).agg(F.min("n").alias("n"), F.sum("n").alias("all"))
    survivors = cut_lineage(shared.join(smallest, "doc_id").where(100 * F.col("shared") >= percent * F.col("n"))
                            .select("doc_id", F.col("all").alias("n")))
    left = with_ids(reps, survivors.select("doc_id"), "left_semi")

    by_doc = shared_keys(left.mapInArrow(lambda batches: gather(batches, pairs, folded=False), ROW), buckets,
                         with_counts=True).select("doc_id", "keys", "counts")

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, chosen = [], []
            for doc, n, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                key, count = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int32)
                prefix = n - -(-percent * n // 100) + 1 - (n - len(key))
                if prefix > 0:
                    ids.append(doc)
                    chosen.append(key[np.lexsort((key, count))[:prefix]])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(chosen, pa.list_(pa.int64()))],
                                             names=["doc_id", "keys"])

    prefixes = by_doc.join(survivors, "doc_id").select("doc_id", "n", "keys", "counts").mapInArrow(
        trimmed_stream(rarest), "doc_id long, keys array<long>").select("doc_id", F.explode("keys").alias("key"))
    prefixes = cut_lineage(prefixes)
    lowest = prefixes.groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1")
    routed = components(prefixes.join(lowest, F.col("key") == F.col("_key")).select("a", F.col("doc_id").alias("b")))

    members = routed.join(survivors, F.col("node") == F.col("doc_id")).select("doc_id", "component", "n")
    blocks = F.greatest(F.ceil(F.sum("n") / block_shingles), F.ceil(F.count(F.lit(1)) / block_documents))
    cut = members.groupBy(F.col("component").alias("_c")).agg(blocks.cast("int").alias("blocks"), F.count(F.lit(1)).alias("m")).where("m > 1")
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    seats = cut_lineage(members.join(cut, F.col("component") == F.col("_c")).select("doc_id", "component", "blocks", block.alias("block")))

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                text, key = shingles(b.column(1).slice(lo, hi - lo), size)
                cuts = np.searchsorted(text, np.arange(hi - lo + 1))
                packed = [key[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
                part = [c.slice(lo, hi - lo) for c in b.columns]
                yield pa.RecordBatch.from_arrays([part[0], *part[2:], pa.array(packed, pa.binary())],
                                                 names=["doc_id", "component", "blocks", "block", "elements"])

    few = seats.count() <= MOST_BROADCAST
    seated = left.join(F.broadcast(seats) if few else seats, "doc_id").select("doc_id", "text", "component", "blocks", "block") \
        .mapInArrow(trimmed_stream(as_sets), "doc_id long, component long, blocks int, block int, elements binary")
    # A cluster of one block is one group; of more, each two blocks are.
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))
    grouped = seated.select("*", F.explode(other).alias("_other")).select(
        "doc_id", "component", "blocks", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "elements")

    def tree(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        found = tree_components([np.frombuffer(table.column("elements")[int(i)].as_py(), np.uint64) for i in order], percent)
        return pa.table([pa.array(ids[order]), pa.array(ids[order][found]), table.column("blocks").combine_chunks()],
                        names=["a", "b", "blocks"])

    links = cut_lineage(grouped.groupBy("component", "low", "high").applyInArrow(trimmed(tree), "a long, b long, blocks int"))
    whole = links.where("blocks = 1").select(F.col("a").alias("node"), F.col("b").alias("component"))
    split = links.where("blocks > 1")
    if split.limit(1).count():
        whole = whole.unionByName(components(split.select("a", "b")))
    linked = whole.groupBy(F.col("node").alias("first")).agg(F.min("component").alias("component"))
    of_class = firsts.join(linked, "first", "left").select("n", "one", "two", F.coalesce("component", "first").alias("_component"))
    own_component = F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return sets.join(of_class, ["n", "one", "two"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own_component).alias("component_id"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of every component, unchanged; of rows that share its id one stays.

    Documents without words and rows without an id all stay.
    """
    found = cut_lineage(join_components(docs, id_col=id_col, text_col=text_col, **options))
    gone = cut_lineage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
    few = gone.count() <= MOST_BROADCAST
    kept = docs.join(F.broadcast(gone) if few else gone, col(id_col) == F.col("_gone"), "left_anti")
    repeated = cut_lineage(found.where("doc_id = component_id and n_shingles > 0").groupBy(F.col("doc_id").alias("_twice"))
                           .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_twice"))
    if repeated.count() == 0:
        return kept
    on = col(id_col) == F.col("_twice")
    return kept.join(repeated, on, "left_anti").unionByName(kept.join(repeated, on, "left_semi").dropDuplicates([id_col]))


JOIN_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.first, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
LEFT JOIN (SELECT node, min(seen) AS first FROM r GROUP BY 1) k ON k.node = w.doc_id
"""
