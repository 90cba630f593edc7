"""Exchange of 64-bit keys between documents in compact rows.

A task gathers (document, key) pairs, sorts them by ranges of the key ("parts") and sends per part one row
of packed arrays: some 6 bytes a pair, where a plain row takes 20. All equal keys meet in one part. Keys
that come twice in one task are folded there, so a key that a third of all documents hold
costs its part one pair per task, not one per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medlark.llm.common import trim, trimmed

#: Pairs that a task gathers before it sends them; documents likewise.
FLUSH_PAIRS = 1_000_000
FLUSH_DOCUMENTS = 50_000
#: Pairs that a part holds, about.
PART_PAIRS = 1_000_000
#: Documents whose answers are put together in one go, about.
DOCUMENTS_PER_BUCKET = 2_000
#: Bits of a key that tell keys of one part apart.
LOW_BITS = 40
ROW = "part int, docs binary, at binary, low binary, high binary"
#: Stands for "two documents or more" of a folded key.
FOLDED = np.int64(np.iinfo(np.int64).min)

_LOW = np.uint64((1 << LOW_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def parts_for(pairs: float) -> int:
    return int(min(1 << 23, max(8, pairs // PART_PAIRS + 1)))


def place(h: np.ndarray, parts: int) -> np.ndarray:
    """Part and low bits of a hash in one number: what a key is known by."""
    part = ((h >> np.uint64(LOW_BITS)) * np.uint64(parts)) >> np.uint64(64 - LOW_BITS)
    return ((part << np.uint64(LOW_BITS)) | (h & _LOW)).astype(np.int64)


def _row(part: int, docs: np.ndarray, keys: np.ndarray) -> tuple:
    used, at = np.unique(docs, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, low = at[order], keys[order].astype(np.uint64) & _LOW
    return (part, np.diff(used, prepend=np.int64(0)).tobytes(), np.diff(at, prepend=0).astype(np.uint16).tobytes(),
            low.astype(np.uint32).tobytes(), (low >> np.uint64(32)).astype(np.uint8).tobytes())


def unpack(docs: bytes, at: bytes, low: bytes, high: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Documents and low bits of one row."""
    used = np.cumsum(np.frombuffer(docs, np.int64))
    index = np.cumsum(np.frombuffer(at, np.uint16).astype(np.int64))
    bits = np.frombuffer(low, np.uint32).astype(np.int64) | (np.frombuffer(high, np.uint8).astype(np.int64) << 32)
    return used[index], bits


def send(docs: np.ndarray, keys: np.ndarray, folded: bool) -> pa.RecordBatch:
    """Rows for pairs (distinct) of a document id and a placed key.

    With ``folded``, pairs whose key comes twice here are known to be shared and go straight on, under a
    negative part number; the key's part just gets a mark.
    """
    rows = []
    if folded:
        order = np.argsort(keys, kind="stable")
        docs, keys = docs[order], keys[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        many = np.diff(np.append(start, len(keys))) > 1
        twice = np.repeat(many, np.diff(np.append(start, len(keys))))
        if twice.any():
            direct = keys[twice]
            own = docs[twice]
            by_doc = np.argsort(own, kind="stable")
            used, first = np.unique(own[by_doc], return_index=True)
            rows.append((-1 - int(used[0] % 1_000_003), used.tobytes(),
                         np.diff(np.append(first, len(own))).astype(np.int64).tobytes(), direct[by_doc].tobytes(), b""))
            marks = keys[start[many]]
            docs = np.concatenate([docs[~twice], np.full(len(marks), FOLDED)])
            keys = np.concatenate([keys[~twice], marks])
    part = keys >> LOW_BITS
    order = np.argsort(part, kind="stable")
    docs, keys, part = docs[order], keys[order], part[order]
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.append(cuts[1:], len(part))):
        rows.append(_row(int(part[a]), docs[a:b], keys[a:b]))
    cells = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cells[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cells[1:]]],
                                      names=["part", "docs", "at", "low", "high"])


def gather(
    batches: Iterator[pa.RecordBatch], pairs_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, int]]],
    folded: bool = True,
) -> Iterator[pa.RecordBatch]:
    """Send what ``pairs_of`` finds in batches: (document ids, placed keys, documents) at a time."""
    docs, keys, n, seen = [], [], 0, 0
    for batch in batches:
        for d, k, documents in pairs_of(batch):
            docs.append(d)
            keys.append(k)
            n, seen = n + len(k), seen + documents
            if n >= FLUSH_PAIRS or seen >= FLUSH_DOCUMENTS:
                yield send(np.concatenate(docs), np.concatenate(keys), folded)
                docs, keys, n, seen = [], [], 0, 0
                trim()
    if docs:
        yield send(np.concatenate(docs), np.concatenate(keys), folded)
    del docs, keys
    trim()


def bucket_rows(docs: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[tuple]:
    """One row per bucket of documents: bucket, documents, entries of each, packed columns."""
    bucket = (mix(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((docs, bucket))
    docs, bucket, columns = docs[order], bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(docs) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(docs))):
        used, n = np.unique(docs[a:b], return_counts=True)
        rows.append((int(bucket[a]), used.tobytes(), n.astype(np.int32).tobytes(), *[c[a:b].tobytes() for c in columns]))
    return rows


def unbucket(table: pa.Table, kinds: list) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """All rows of one bucket, by document: documents, columns, and where each document starts and ends."""
    docs, n, *columns = ([x.as_py() for x in table.column(i)] for i in range(1, table.num_columns))
    flat = np.concatenate([np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.int32)) for d, c in zip(docs, n)])
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    columns = [np.frombuffer(b"".join(c), k)[order] for c, k in zip(columns, kinds)]
    cuts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
    return flat, columns, cuts, np.append(cuts[1:], len(flat))


def count_of(table: pa.Table) -> pa.Table:
    """Documents of one bucket with the number of their shared keys."""
    docs = np.concatenate([np.frombuffer(d.as_py(), np.int64) for d in table.column("docs")])
    n = np.concatenate([np.frombuffer(c.as_py(), np.int32) for c in table.column("n")])
    used, at = np.unique(docs, return_inverse=True)
    sums = np.bincount(at, weights=n, minlength=len(used)).astype(np.int64)
    return pa.table([pa.array(used), pa.array(sums)], names=["doc_id", "n"])


def buckets_for(documents: int) -> int:
    return documents // DOCUMENTS_PER_BUCKET + 1


def shared_keys(rows: DataFrame, buckets: int, with_counts: bool = False, only_number: bool = False) -> DataFrame:
    """The keys of each document that another one holds too: doc_id, n, keys, counts.

    With ``only_number`` just doc_id and n, the number of keys.

    ``keys`` packs 64-bit placed keys; ``counts``, on demand, packs 32-bit numbers of documents (rows
    must then be sent unfolded). A part answers with one row per bucket of documents, and a bucket
    puts its documents together, so the number of rows follows the parts, not the documents in each.
    """
    def reduce(table: pa.Table) -> pa.Table:
        number = table.column("part")[0].as_py()
        cells = [table.column(c).to_pylist() for c in ("docs", "at", "low", "high")]
        if number < 0:
            docs = np.concatenate([np.repeat(np.frombuffer(d, np.int64), np.frombuffer(n, np.int64)) for d, n, _, _ in zip(*cells)])
            keys, held = np.frombuffer(b"".join(cells[2]), np.int64), np.full(len(docs), 2)
        else:
            found = [unpack(*row) for row in zip(*cells)]
            docs = np.concatenate([f[0] for f in found])
            low = np.concatenate([f[1] for f in found])
            _, at = np.unique(low, return_inverse=True)
            held = np.bincount(at, weights=np.where(docs == FOLDED, 2, 1)).astype(np.int64)[at]
            use = (held > 1) & (docs != FOLDED)
            docs, keys, held = docs[use], low[use] | (np.int64(number) << LOW_BITS), held[use]
        columns = [] if only_number else [keys, held.astype(np.int32)] if with_counts else [keys]
        cols = list(zip(*bucket_rows(docs, columns, buckets))) or [()] * len(names)
        return pa.table([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)

    def merge(table: pa.Table) -> pa.Table:
        docs, columns, cuts, ends = unbucket(table, [np.int64, np.int32])
        packed = [pa.array([c[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()) for c in columns]
        if not with_counts:
            packed.append(pa.nulls(len(cuts), pa.binary()))
        return pa.table([pa.array(docs[cuts]), pa.array(ends - cuts), *packed], names=["doc_id", "n", "keys", "counts"])

    names = ["bucket", "docs", "n", *([] if only_number else ["keys", *["counts"] * with_counts])]
    answers = rows.groupBy("part").applyInArrow(trimmed(reduce), "bucket int, " + ", ".join(f"{c} binary" for c in names[1:]))
    if only_number:
        return answers.groupBy("bucket").applyInArrow(trimmed(count_of), "doc_id long, n long")
    return answers.groupBy("bucket").applyInArrow(trimmed(merge), "doc_id long, n long, keys binary, counts binary")
