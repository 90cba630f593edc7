"""Best-fit packing of tokenised documents into sequences, planned on a length histogram."""

from __future__ import annotations

import os
from array import array
from bisect import bisect_left, insort
from binascii import crc32
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import ROWS_PER_BUCKET, Words, keyed_order, running_sums, slices, spread

CAPACITY = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
#: Words whose tokens a worker remembers from slice to slice, and again as many used before.
REMEMBERED = 400_000
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Coder:
    """Ids of words, as bytes; recent words are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def look_up(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct strings."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        new = [p for p in parts if p not in recent]
        known = {p: older[p] for p in new if p in older}
        new = [p for p in new if p not in known]
        recent.update(known)
        coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        recent.update((p, array("I", e.ids).tobytes()) for p, e in zip(new, coded))
        return recent

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Marks at the end of a word of letters are tokens of their own, so the two are coded apart."""
        texts = [w.decode("utf-8", "replace") for w in words]
        cores = [t.rstrip(_MARKS) for t in texts]
        plain = [c.isalpha() for c in cores]
        cores = [(c.lower() if c.isascii() else c) if p else t for c, t, p in zip(cores, texts, plain)]
        # What is left of a plain word after its letters; lower case keeps the length of ASCII.
        ends = [t[len(c):] if p else "" for t, c, p in zip(texts, cores, plain)]
        ids = self.look_up(list({*cores, *ends} - {""}))
        return [ids[c] + ids[e] if e else ids[c] for c, e in zip(cores, ends)]


@lru_cache(maxsize=2)
def _coder(path: str) -> _Coder:
    return _Coder(path)


def token_ids(texts: pa.Array, path: str, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end``, and where each text's ids start.

    The tokenizer lowers case, drops white space and never joins characters across it, so a
    text's ids are those of its words in turn, and a word is tokenised once.
    """
    words = Words(texts)
    stored = [*_coder(path)(words.vocabulary), np.uint32(end).tobytes()]
    flat = np.frombuffer(b"".join(stored), np.uint32)
    size = np.fromiter(map(len, stored), np.int64, len(stored)) // 4
    first = np.cumsum(size) - size
    sequence = np.insert(words.ids, words.offsets[1:], len(words.vocabulary))
    n = size[sequence]
    ids = flat[spread(first[sequence], n)]
    before = np.concatenate([[0], np.cumsum(n)])
    return ids, before[words.offsets + np.arange(len(words.offsets))]


def pieces(docs: DataFrame, path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; only a longer document has more than one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                ids, at = token_ids(batch.column(1).slice(lo, hi - lo), path)
                n = np.diff(at)
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), parts)
                piece = spread(np.zeros(hi - lo, np.int64), parts)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                crc = [crc32(ids[a:a + m].astype("<u4").tobytes()) for a, m in zip(at[doc] + start, length)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECE)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """Best-fit decreasing over counts: slots as (length, first rank, first sequence, offset).

    Sequences that hold the same lengths are one group with a count. The next shorter length goes
    to the group with the least room that still fits, as many at a time as both have. A group is
    split once at most per length, so the plan is bounded by the capacity, not by the documents.
    The pieces of one length with ranks from ``first rank`` up to the next slot's take the
    sequences from ``first sequence`` on, one each, at ``offset``.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, sequences)]
    rooms: list[int] = []
    slots: list[tuple[int, int, int, int]] = []
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                put(capacity, opened, left)
                opened += left
                # New sequences are opened only for what fits nowhere; each takes several at once below.
                each = capacity // length
                need = -(-left // each)
                groups[capacity][-1] = (opened - left, need)
                opened += need - left
                continue
            room = rooms[i]
            first, n = groups[room].pop()
            take = min(left, n)
            slots.append((length, rank, first, capacity - room))
            left, rank = left - take, rank + take
            if n > take:
                groups[room].append((first + take, n - take))
            if not groups[room]:
                del groups[room]
                rooms.remove(room)
            if room > length:
                put(room - length, first, take)
    return tuple(np.array(c, np.int64) for c in zip(*sorted(slots))) if slots else tuple(
        np.zeros(0, np.int64) for _ in range(4))


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text", seed: str = "pack", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Place every piece of every document in a sequence of at most ``capacity`` tokens.

    Counts of pieces by length go to the driver (as many numbers as the capacity), the plan
    comes back, and each piece takes the planned slot of its length and its rank there. Ranks are
    hash-ordered in buckets, so a length that a third of all pieces share is split.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or blank text is
    the end token alone. Repeated rows are packed one by one; null ids are kept. Other columns are
    ignored. An empty table gives no rows.
    """
    found = cut_lineage(pieces(docs, tokenizer, capacity, id_col, text_col))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths, ranks, sequences, offsets = plan(counts, capacity)
    ranked = running_sums(
        found.withColumn("_key", keyed_order(seed, F.col("doc_id"), F.col("piece"))), ["length"], "_key",
        ["doc_id", "piece", "ids_crc32"], {"_rank": F.lit(1)}, {}, sum(counts.values()), rows_per_bucket)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slots are in order of (length, rank): the last at or before a piece is its own.
        most = max(counts.values(), default=0) + 1
        keys = lengths * most + ranks
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            at = np.searchsorted(keys, length * most + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("_rank").cast("long")) \
        .mapInArrow(seat, PIECE + ", sequence_id long, offset long")
