"""Removal of repeated word sequences, found by recompression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import Words, slices, spread, trimmed, trimmed_stream
from medlark.llm.exchange import (
    FLUSH_DOCUMENTS, FLUSH_PAIRS, bucket_rows, buckets_for, gather, mix, parts_for, place, shared_keys, unbucket,
)

WINDOW = 13
#: Rounds of naming: a symbol of round 2 with its surroundings mostly fits into a window.
ROUNDS = 2
#: Bytes of text per word and pairs per word, for the number of parts.
_BYTES_PER_WORD, _PAIRS_PER_WORD = 6, 0.6
_ODD = np.uint64(0x9E3779B97F4A7C15)

HASHED = "part int, docs binary, row_keys binary, at binary, starts binary, low binary, mid binary"


class Symbols:
    """A parse of some texts: names of symbols, their words and the words that decide them.

    Equal words have equal names, and a round names runs of one symbol and then pairs, by nothing
    but names: so an occurrence of a word sequence is parsed like every other one, except near its ends.
    ``left`` to ``right`` (exclusive) are the words that fix a symbol: wherever they stand, it is there.
    """

    def __init__(self, name: np.ndarray, text: np.ndarray, offsets: np.ndarray):
        self.name, self.text = name, text
        self.left = np.arange(len(name))
        self.right = self.left + 1
        self.low, self.high = offsets[text], offsets[text + 1]

    def _take(self, at: np.ndarray) -> None:
        self.text, self.low, self.high = self.text[at], self.low[at], self.high[at]

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """``left`` of the symbol before and ``right`` of the one after; outside the text beyond its ends."""
        same = self.text[1:] == self.text[:-1]
        before, after = self.low - 1, self.high + 1
        before[1:][same] = self.left[:-1][same]
        after[:-1][same] = self.right[1:][same]
        return before, after

    def runs(self) -> None:
        """Name each run of equal symbols; a symbol alone keeps its name but now knows its neighbours."""
        n = len(self.name)
        if not n:
            return
        fresh = np.append(True, (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1]))
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], n) - 1
        size = (last - first + 1).astype(np.uint64)
        before, after = self._neighbours()
        self.left, self.right = before[first], after[last]
        name = self.name[first]
        self.name = np.where(size > 1, mix(name + size * _ODD), name)
        self._take(first)

    def pairs(self, number: int) -> None:
        """Pair each symbol of the first half of the alphabet with a following one of the second."""
        n = len(self.name)
        if not n:
            return
        salt = np.uint64((number + 1) * int(_ODD) % (1 << 64))
        opens = (mix(self.name + salt) & np.uint64(1)).astype(bool)
        starts = np.zeros(n, bool)
        starts[:-1] = opens[:-1] & ~opens[1:] & (self.text[1:] == self.text[:-1])
        seconds = np.append(False, starts[:-1])
        before, after = self._neighbours()
        at = np.flatnonzero(~seconds)
        pair = starts[at]
        following = np.minimum(at + 1, n - 1)
        # An opening symbol alone depends on the next one, a closing one on that before.
        left = np.where(pair | opens[at], self.left[at], before[at])
        right = np.where(pair, self.right[following], np.where(opens[at], after[at], self.right[at]))
        name = np.where(pair, mix(self.name[at] * _ODD + mix(self.name[following])), self.name[at])
        self.name, self.left, self.right = name, left, right
        self._take(at)


def parse(names: np.ndarray, text: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = Symbols(names, text, offsets)
    for r in range(rounds):
        symbols.runs()
        symbols.pairs(r)
    return symbols


def word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every word."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.vocabulary)) or b"", np.uint64).reshape(-1, 2)
    return digests[words.ids, 0], digests[words.ids, 1]


def _inner(names: np.ndarray, words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols fixed by the words of one window at most: text, left, right, hash of symbol and words."""
    s = parse(names, words.texts(), words.offsets)
    ok = (s.left >= s.low) & (s.right <= s.high) & (s.right - s.left <= window)
    left, right = s.left[ok], s.right[ok]
    # A polynomial hash of the words between, by differences of running sums.
    power = np.multiply.accumulate(np.full(len(names) + 1, _ODD)) if len(names) else np.ones(1, np.uint64)
    inverse = np.multiply.accumulate(np.full(len(names) + 1, np.uint64(pow(int(_ODD), -1, 1 << 64))))
    sums = np.append(np.uint64(0), np.cumsum(names * power[:-1], dtype=np.uint64))
    between = (sums[right] - sums[left]) * inverse[left]
    return s.text[ok], left, right, mix(between + s.name[ok] * np.uint64(3) + (right - left).astype(np.uint64))


def _window_hashes(first: np.ndarray, second: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the words of each window, 128 bits together."""
    a, b = np.zeros(len(starts), np.uint64), np.full(len(starts), _ODD)
    for i in range(window):
        a = mix(a * _ODD + first[starts + i])
        b = mix(b + second[starts + i] * _ODD)
    return a, b


def _candidates(words: Words, first: np.ndarray, known: list[np.ndarray | None], parts: int, window: int) -> np.ndarray:
    """Starts of the windows all of whose inner symbols are shared; ``known``: shared keys by text.

    A window that no symbol decides (inside long runs of a word) is one of them.
    """
    text, left, right, h = _inner(first, words, window)
    n = len(first)
    key = place(h, parts)
    shared = np.zeros(len(key), bool)
    cuts = np.searchsorted(text, np.arange(len(known) + 1))
    for i, keys in enumerate(known):
        a, b = cuts[i], cuts[i + 1]
        if keys is not None and b > a:
            shared[a:b] = np.isin(key[a:b], keys)
    dead = np.zeros(n + 2, np.int64)
    lone = ~shared
    low = np.maximum(right[lone] - window, words.offsets[text[lone]])
    np.add.at(dead, low, 1)
    np.add.at(dead, left[lone] + 1, -1)
    size = np.diff(words.offsets)
    room = np.maximum(size - window + 1, 0)
    starts = spread(words.offsets[:-1], room)
    alive = np.cumsum(dead)[starts] <= 0
    return starts[alive]


def _send_windows(doc: np.ndarray, row: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows by part. Of windows that come in several documents here, all but the first document's are
    known to be repeats and go straight on, under a negative part."""
    order = np.lexsort((doc, b, a))
    doc, row, start, a, b = (x[order] for x in (doc, row, start, a, b))
    fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    later = doc > doc[np.flatnonzero(fresh)][group] if len(a) else np.zeros(0, bool)
    direct = -1 - int(doc[0]) % 1_000_003 if len(doc) else -1
    part = np.where(later, direct, (a >> np.uint64(40)).astype(np.int64) * parts >> 24)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(part) else np.zeros(0, np.int64)
    rows = []
    for lo, hi in zip(cuts, np.append(cuts[1:], len(part))):
        i = order[lo:hi]
        pairs = np.stack([doc[i], row[i]], 1)
        used, at = np.unique(pairs, axis=0, return_inverse=True)
        at = at.ravel()
        by = np.argsort(at, kind="stable")
        i, at = i[by], at[by]
        known = part[i[0]] < 0
        rows.append((int(part[i[0]]), np.ascontiguousarray(used[:, 0]).tobytes(), np.ascontiguousarray(used[:, 1]).tobytes(),
                     at.astype(np.uint32).tobytes(), start[i].astype(np.uint32).tobytes(),
                     b"" if known else a[i].tobytes(), b"" if known else (b[i] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()))
    cells = list(zip(*rows)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(cells[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cells[1:]]],
                                      names=["part", "docs", "row_keys", "at", "starts", "low", "mid"])


def _repeats(table: pa.Table, buckets: int) -> pa.Table:
    """Of one part the windows that a smaller document has too, by bucket of documents."""
    number = table.column("part")[0].as_py()
    doc, row, start, a, b = [], [], [], [], []
    for docs, rows, at, starts, low, mid in zip(*(table.column(c).to_pylist() for c in table.column_names[1:])):
        i = np.frombuffer(at, np.uint32)
        doc.append(np.frombuffer(docs, np.int64)[i])
        row.append(np.frombuffer(rows, np.int64)[i])
        start.append(np.frombuffer(starts, np.uint32))
        a.append(np.frombuffer(low, np.uint64))
        b.append(np.frombuffer(mid, np.uint32))
    doc, row, start = map(np.concatenate, (doc, row, start))
    if number >= 0:
        a, b = np.concatenate(a), np.concatenate(b)
        order = np.lexsort((doc, b, a))
        fresh = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        least = doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        use = order[doc[order] > least]
        doc, row, start = doc[use], row[use], start[use]
    cells = list(zip(*bucket_rows(doc, [row, start], buckets))) or [()] * 5
    return pa.table([pa.array(cells[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cells[1:]]],
                    names=["bucket", "docs", "n", "row_keys", "starts"])


def _starts(table: pa.Table) -> pa.Table:
    """The starts of one bucket's repeats by document and text."""
    doc, (row, start), _, _ = unbucket(table, [np.int64, np.uint32])
    order = np.lexsort((start, row, doc))
    doc, row, start = doc[order], row[order], start[order]
    cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(doc))
    return pa.table([pa.array(doc[cuts]), pa.array(row[cuts]),
                     pa.array([start[x:y].tobytes() for x, y in zip(cuts, ends)], pa.binary())],
                    names=["doc_id", "row_key", "starts"])


def _keep(text: str, mask: np.ndarray) -> str:
    words = text.encode().split()
    return b" ".join(w for w, gone in zip(words, mask) if not gone).decode()


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
) -> DataFrame:
    """Remove words covered by a window that also stands in a document with a smaller id.

    1. Recompression: every text is parsed into symbols in rounds that name runs and pairs by hashes, the same
    for all documents. Each inner symbol, with the words that fix it, is exchanged; those that two documents
    hold are shared. 2. A window all of whose inner symbols are shared is a candidate, as is the rare
    one that lies inside runs and has none. No repeat is lost, since equal windows have equal inner symbols. 3. Candidates
    are compared by hashes of all their words (96 bits), and every repeat but that of the smallest document
    goes. Texts equal to one of a smaller document skip this: all their windows are repeats.

    Returns doc_id, text (as given), n_words, n_removed, kept (the kept words joined by a space). Null and
    short texts have no window and lose nothing; a null id neither loses nor takes anything. Repeated rows
    (one id) do not count against each other. Other columns are ignored; with ``carry`` they come back in ``_row``,
    with whether the text was null.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    row = F.struct(col(text_col).isNull().alias("null"), F.struct(*[col(c) for c in docs.columns if c != text_col]).alias("rest"))
    rest = [row.alias("_row")] if carry else []
    own = docs.select(col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_key"), *rest)
    carried = ["_row"] if carry else []
    narrow = cut_lineage(own.select("doc_id", "row_key", F.sha2("text", 256).alias("digest"),
                                    F.octet_length("text").cast("long").alias("bytes")).where(F.col("doc_id").isNotNull()))
    size, count = narrow.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    parts, buckets = parts_for(size / _BYTES_PER_WORD * _PAIRS_PER_WORD), buckets_for(count)

    def symbols(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for lo, hi in slices(batch.column(1)):
            words = Words(batch.column(1).slice(lo, hi - lo))
            text, _, _, h = _inner(word_hashes(words)[0], words, window)
            key = place(h, parts)
            pairs = np.unique(np.stack([text, key], 1), axis=0) if len(key) else np.zeros((0, 2), np.int64)
            yield batch.column(0).slice(lo, hi - lo).to_numpy()[pairs[:, 0]], pairs[:, 1], hi - lo

    first = own.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(
        lambda batches: gather(batches, symbols), "part int, docs binary, at binary, low binary, high binary")
    shared = shared_keys(first, buckets).select("doc_id", "keys")
    # One row per (document, text): whether a smaller document has this very text.
    same = Window.partitionBy("digest")
    rows = narrow.groupBy("digest", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "copy", F.min("doc_id").over(same) < F.col("doc_id")).select("doc_id", "row_key", "copy")
    info = rows.join(shared, "doc_id", "left")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = seen = 0
        for b in batches:
            for lo, hi in slices(b.column(1)):
                words = Words(b.column(1).slice(lo, hi - lo))
                known = [np.frombuffer(k, np.int64) if k else None for k in b.column(3).slice(lo, hi - lo).to_pylist()]
                one, two = word_hashes(words)
                starts = _candidates(words, one, known, parts, window)
                text = np.searchsorted(words.offsets, starts, side="right") - 1
                # Copies, and rows without an id, are not compared.
                own = pc.equal(b.column(4).slice(lo, hi - lo), False).fill_null(False).to_numpy(zero_copy_only=False)[text]
                starts, text = starts[own], text[own]
                a, c = _window_hashes(one, two, starts, window)
                held.append((b.column(0).slice(lo, hi - lo).fill_null(0).to_numpy()[text], b.column(2).slice(lo, hi - lo).to_numpy()[text],
                             starts - words.offsets[text], a, c))
                n, seen = n + len(starts), seen + hi - lo
                if n >= FLUSH_PAIRS or seen >= FLUSH_DOCUMENTS:
                    yield _send_windows(*map(np.concatenate, zip(*held)), parts)
                    held, n, seen = [], 0, 0
        if held:
            yield _send_windows(*map(np.concatenate, zip(*held)), parts)

    # Left joins, both: so text is exchanged once and read twice.
    second = own.join(info, ["doc_id", "row_key"], "left").select("doc_id", "text", "row_key", "keys", "copy", *carried) \
        .mapInArrow(trimmed_stream(windows), HASHED)
    repeats = second.groupBy("part").applyInArrow(
        trimmed(lambda table: _repeats(table, buckets)), "bucket int, docs binary, n binary, row_keys binary, starts binary") \
        .groupBy("bucket").applyInArrow(trimmed(_starts), "doc_id long, row_key long, starts binary")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                texts = b.column(1).slice(lo, hi - lo)
                sizes = np.diff(Words(texts).offsets)
                removed, kept = [], []
                for text, n, copy, starts in zip(texts.to_pylist(), sizes, b.column(2).slice(lo, hi - lo).to_pylist(),
                                                 b.column(3).slice(lo, hi - lo).to_pylist()):
                    edge = np.zeros(n + 1, np.int64)
                    if copy and n >= window:
                        edge[0], edge[n] = 1, -1
                    elif starts:
                        at = np.frombuffer(starts, np.uint32)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + window, -1)
                    mask = np.cumsum(edge[:-1]) > 0
                    removed.append(int(mask.sum()))
                    kept.append(_keep(text, mask))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), texts, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.string()), *[c.slice(lo, hi - lo) for c in b.columns[4:]]],
                    names=["doc_id", "text", "n_words", "n_removed", "kept", *carried])

    marked = own.join(rows.join(repeats, ["doc_id", "row_key"], "left"), ["doc_id", "row_key"], "left")
    kinds = T.StructType.fromDDL("doc_id long, text string, n_words long, n_removed long, kept string")
    return marked.select("doc_id", "text", "copy", "starts", *carried).mapInArrow(
        trimmed_stream(remove), T.StructType([*kinds.fields, *[own.schema[c] for c in carried]]))


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated words taken out; a text that loses nothing stays as it is, white space too."""
    found = remove_repeats(docs, window, id_col, text_col, carry=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).when(~F.col("_row.null"), F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("_row.rest")[c].alias(c) for c in docs.columns])


REPEATS_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 11, 1))) AS p, w FROM w WHERE len(w) >= 13),
h AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 12], ' ')) AS h FROM g),
m AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM h),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM m WHERE doc_id > first),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
r AS (SELECT t.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.i = c.i GROUP BY t.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r ON w.doc_id = r.doc_id
"""
