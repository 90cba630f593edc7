"""Alignment of two tokenizers over the same texts, by byte ranges.

A text is cut where neither tokenizer can join characters, so both are run once per distinct chunk and
what a chunk gives (tokens, groups, links) is added up by document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import slices, spread, trim, trimmed_stream

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
#: Chunks whose alignment a worker remembers from slice to slice, and again as many used before.
REMEMBERED = 75_000
#: Chunks that are given to the tokenizers as one text.
JOINED = 1_000
#: Bytes of such texts that are tokenised at once: tokens take some hundred times their text while both tokenizers hold them.
LEARNED_BYTES = 128 << 10
#: Id pairs that a task adds up before it sends them.
FLUSH_LINKS = 500_000
#: Bytes of text whose chunks are aligned in one go and stored in one row, which takes about as much: JVMs copy rows several times.
SLICE_BYTES = 256 << 10
#: How slices are stored: writers hold, and readers load, a few rows at a time, not all of a task (sizes are looked at after every row).
STORED = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 8}
#: Id pairs whose counts are sent to every task (24 bytes each); beyond, they are joined by a shuffle.
MOST_SENT = 4_000_000
#: A pair of ids in one number.
ID_BITS = 32
_ID = (1 << ID_BITS) - 1
_SPACE = "▁"

ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Tokens(NamedTuple):
    """Tokens of some texts, one text after the other: ids, where each ends in its text's bytes, tokens per text."""

    ids: np.ndarray
    ends: np.ndarray
    n: np.ndarray


class Aligned(NamedTuple):
    """What one chunk gives: tokens of both, groups, the groups as text, its links as packed id pairs."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves; the others take the code points from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _tokens(ids: list[list[int]], lengths: np.ndarray, raw: list[bytes]) -> Tokens:
    """Each token ends where its bytes and those before it do; a text whose tokens have not as many bytes as it gets ends of -1."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
    total = np.concatenate([[0], np.cumsum(lengths[flat])])
    bounds = np.concatenate([[0], np.cumsum(n)])
    whole = np.diff(total[bounds]) == np.fromiter(map(len, raw), np.int64, len(raw))
    return Tokens(flat, np.where(np.repeat(whole, n), total[1:] - np.repeat(total[bounds[:-1]], n), -1), n)


class _First:
    """Byte-level BPE by ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        before = told.get("pre_tokenizer") or {}
        #: Words are cut off at white space, and nothing changes the text before.
        self.cuts_words = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not told.get("normalizer")
        byte_of = byte_characters()
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def __call__(self, texts: list[str], raw: list[bytes]) -> Tokens:
        return _tokens([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)], self.lengths, raw)


class _Second:
    """BPE with byte fallback by ``sentencepiece``. It puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(count)]
        special = [self.model.is_control(i) or self.model.is_unknown(i) for i in range(count)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.space = self.model.piece_to_id(_SPACE)
        #: No piece goes on over a space or a line end after another character.
        self.cuts_words = not any(
            re.search(f"[^{_SPACE}]{_SPACE}|\n", p) for i, p in enumerate(pieces)
            if not special[i] and not self.model.is_byte(i))

    def __call__(self, texts: list[str], raw: list[bytes]) -> Tokens:
        """Of chunks as they stand: the space put before is the chunk's own first one, or is taken out again."""
        own = [t.startswith(" ") for t in texts]
        ids = self.model.encode([t[o:] for t, o in zip(texts, own)], out_type=int, num_threads=1)
        for i, (found, o, t) in enumerate(zip(ids, own, texts)):
            if not found and t == " ":
                ids[i] = [self.space]
            elif not o and found and found[0] == self.space:
                ids[i] = found[1:]
        return _tokens(ids, self.lengths, raw)


class _Texts:
    """An id as text, with what may follow it: another id, the other tokenizer's ids, the next group."""

    def __init__(self, n: int):
        self.more, self.other, self.group = (np.array([f"{i}{mark}" for i in range(n)], object) for mark in ",|;")

    def __call__(self, ids: np.ndarray, last: np.ndarray, ending: np.ndarray) -> np.ndarray:
        return np.where(last, ending[ids], self.more[ids])


def _cut_up(sizes: np.ndarray, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray,
            a_texts: _Texts, b_texts: _Texts) -> list[Aligned]:
    """Alignments of chunks that stand one after the other, each ended by a token of both."""
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_of, b_of = np.searchsorted(shared, a_ends, side="left"), np.searchsorted(shared, b_ends, side="left")
    a_cut, b_cut = np.searchsorted(a_ends, shared, side="right"), np.searchsorted(b_ends, shared, side="right")
    # Groups as text: the ids of the first, then those of the second, group after group.
    written = np.empty(len(a) + len(b), object)
    written[np.arange(len(a)) + np.concatenate([[0], b_cut])[a_of]] = a_texts(a, a_ends == shared[a_of], a_texts.other)
    written[np.arange(len(b)) + a_cut[b_of]] = b_texts(b, b_ends == shared[b_of], b_texts.group)
    # The first token of b that ends after this one starts, up to the one that reaches its end.
    lo = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), side="right")
    n = np.searchsorted(b_ends, a_ends, side="left") - lo + 1
    pairs = (np.repeat(a, n) << ID_BITS | b[spread(lo, n)]).astype("<i8").tobytes()
    ends = np.cumsum(sizes)
    a_end, b_end = np.searchsorted(a_ends, ends, side="right"), np.searchsorted(b_ends, ends, side="right")
    link_end = np.concatenate([[0], np.cumsum(n)])[a_end] * 8
    group_end = np.searchsorted(shared, ends, side="right")
    parts, out, i, j, k, g = written.tolist(), [], 0, 0, 0, 0
    for x, y, z, h in zip(a_end.tolist(), b_end.tolist(), link_end.tolist(), group_end.tolist()):
        out.append(Aligned(x - i, y - j, h - g, "".join(parts[i + j: x + y])[:-1], pairs[k:z]))
        i, j, k, g = x, y, z, h
    return out


class Aligner:
    """Two tokenizers and the alignments of chunks seen lately."""

    def __init__(self, first: str, second: str):
        self.first, self.second = _First(first), _Second(second)
        self.cuts = self.first.cuts_words and self.second.cuts_words
        self.a_texts, self.b_texts = _Texts(len(self.first.bytes)), _Texts(len(self.second.bytes))
        self.recent: dict[bytes, Aligned | None] = {}
        self.older: dict[bytes, Aligned | None] = {}

    def align(self, raw: list[bytes]) -> dict[bytes, Aligned | None]:
        """Alignments of distinct chunks; None where tokens do not give a chunk's bytes back."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        new = [r for r in raw if r not in recent]
        recent.update((r, older[r]) for r in new if r in older)
        self._learn([r for r in new if r not in recent])
        return recent

    def _learn(self, new: list[bytes]) -> None:
        """Both tokenizers run on many chunks joined, where the next begins as if it stood in a text."""
        units: list[list[bytes]] = [[]]
        for r in new:
            try:
                text = r.decode()
            except UnicodeDecodeError:
                text = _SPACE
            if _SPACE in text:
                # The second tokenizer gives a space for it.
                self.recent[r] = None
                continue
            units[-1].append(r)
            if not self.cuts or text[-1].isspace() or len(units[-1]) == JOINED:
                units.append([])
        held, size = [], 0
        for u in units:
            held += [u] if u else []
            size += sum(map(len, u))
            if size >= LEARNED_BYTES:
                self._learn_units(held)
                held, size = [], 0
        if held:
            self._learn_units(held)

    def _learn_units(self, units: list[list[bytes]]) -> None:
        raw = [b"".join(u) for u in units]
        texts = [r.decode() for r in raw]
        a, b = self.first(texts, raw), self.second(texts, raw)
        good, apart, at = [], [], [[], [], [], []]
        i = j = before = 0
        for unit, whole, n, m in zip(units, raw, a.n.tolist(), b.n.tolist()):
            held = [x[y:y + z] for t, y, z in ((a, i, n), (b, j, m)) for x in (t.ids, t.ends)]
            i, j = i + n, j + m
            ends = np.cumsum([len(r) for r in unit])
            same = n and m and held[1][0] >= 0 and held[3][0] >= 0 \
                and b"".join([self.first.bytes[x] for x in held[0]]) == whole \
                and b"".join([self.second.bytes[x] for x in held[2]]) == whole \
                and np.isin(ends, held[1]).all() and np.isin(ends, held[3]).all()
            if same:
                good += unit
                for to, x, shift in zip(at, held, (0, before, 0, before)):
                    to.append(x + shift)
                before += len(whole)
            elif len(unit) == 1:
                self.recent[unit[0]] = None
            else:
                apart += [[r] for r in unit]
        if good:
            sizes = np.fromiter(map(len, good), np.int64, len(good))
            self.recent.update(zip(good, _cut_up(sizes, *map(np.concatenate, at), self.a_texts, self.b_texts)))
        if apart:
            self._learn_units(apart)


@lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


#: White space, here with control characters that some patterns count among it.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True


def chunks(texts: pa.Array, cut: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Chunks of space+text: (number of each in the list, distinct chunks, where each text's begin).

    A chunk begins at a space or line end right after a character that is surely no white space. Texts that are null or
    empty have none.
    """
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]] if data else np.zeros(0, np.uint8)
    filled = np.flatnonzero(np.diff(bounds))
    at = bounds - bounds[0]
    # A space before every text that is not empty.
    raw = np.insert(raw, at[filled], 32)
    more = np.zeros(len(at), np.int64)
    more[filled + 1] = 1
    at = at + np.cumsum(more)
    begins = np.zeros(len(raw), bool)
    if cut and len(raw):
        back = [np.concatenate([np.zeros(k, np.uint8), raw[:-k]])[: len(raw)] for k in range(1, 5)]
        solid = ((back[0] < 0x80) & ~_WHITE[back[0]]) | (back[0] >= 0x80) & (
            ((back[1] >= 0xC3) & (back[1] <= 0xDF))
            | (back[2] == 0xE0) | ((back[2] >= 0xE4) & (back[2] <= 0xEF)) | (back[3] >= 0xF0))
        begins = solid & ((raw == 32) | (raw == 10))
    begins[at[filled]] = True
    starts = np.flatnonzero(begins)
    cuts = np.append(starts, len(raw)).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))])
    coded = found.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), np.searchsorted(starts, at)


class _Slice(NamedTuple):
    """Alignments of one slice of texts, chunk by chunk."""

    chunk: np.ndarray  # of every occurrence the number in ``known``
    at: np.ndarray  # where the occurrences of each text begin
    known: list[Aligned | None]
    good: np.ndarray  # by text: it has tokens


def _aligned_slice(texts: pa.Array, pair: Aligner) -> _Slice:
    chunk, distinct, at = chunks(texts, pair.cuts)
    found = pair.align(distinct)
    known = [found[c] for c in distinct]
    bad = np.fromiter((k is None for k in known), bool, len(known))
    wrong = np.concatenate([[0], np.cumsum(bad[chunk])])[at]
    return _Slice(chunk, at, known, (np.diff(at) > 0) & (np.diff(wrong) == 0))


def _links(known: list[Aligned | None]) -> tuple[np.ndarray, np.ndarray]:
    """All links of some chunks, one chunk after the other, and how many each has."""
    stored = [k.pairs if k else b"" for k in known]
    return (np.frombuffer(b"".join(stored), "<i8").astype(np.int64),
            np.fromiter(map(len, stored), np.int64, len(stored)) // 8)


def _folded(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
    # Sums stay below 2^53.
    return keys, np.bincount(at, weights=np.concatenate(times), minlength=len(keys)).astype(np.int64)


def _numbers(s: _Slice, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Sums over each text's chunks of numbers by chunk; 0 for a text without tokens."""
    out = []
    for p in parts:
        sums = np.concatenate([[0], np.cumsum(p[s.chunk])])
        out.append(np.where(s.good, np.diff(sums[s.at]), 0))
    return out


def _digests(s: _Slice) -> list[str]:
    groups = [k.groups if k else "" for k in s.known]
    chunk, at = s.chunk.tolist(), s.at.tolist()
    return [hashlib.sha256(";".join([groups[c] for c in chunk[lo:hi]]).encode()).hexdigest() if g else ""
            for lo, hi, g in zip(at[:-1], at[1:], s.good.tolist())]


_TEXTS = "doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"
#: Of a slice of texts, or of id pairs that a task has added up.
_PASS = _TEXTS + ", places array<long>, chunk binary, links binary, linked binary, a binary, b binary, pair array<long>, n array<long>"
_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "chunk", "links", "linked", "a", "b", "pair", "n"]


def _small(most: int) -> np.dtype:
    return np.dtype(np.min_scalar_type(max(most, 1))).newbyteorder("<")


def _row(values: list) -> pa.RecordBatch:
    kinds = [*[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 5, *[pa.list_(pa.int64())] * 2]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=_NAMES)


def aligned_slices(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The one pass over the texts, stored: per slice what each text gives and which links its chunks have; per task counts of id pairs.

    ``docs`` has doc_id and text. Links are stored once per distinct chunk of a slice, as places in the slice's distinct id pairs,
    so they take less than the texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(first, second)
        a_kind, b_kind = _small(len(pair.first.bytes)), _small(len(pair.second.bytes))
        pairs, times, held = [], [], 0
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                s = _aligned_slice(batch.column(1).slice(lo, hi - lo), pair)
                # Texts without tokens link nothing.
                there = np.repeat(s.good, np.diff(s.at))
                chunk = s.chunk[there]
                flat, links = _links(s.known)
                keys, linked = np.unique(flat, return_inverse=True)
                often = np.repeat(np.bincount(chunk, minlength=len(s.known)), links)
                # Sums stay below 2^53.
                sums = np.bincount(linked, weights=often, minlength=len(keys)).astype(np.int64)
                pairs.append(keys[sums > 0])
                times.append(sums[sums > 0])
                held += len(pairs[-1])
                counts = [np.array([getattr(k, f) if k else 0 for k in s.known], np.int64) for f in ("n_a", "n_b", "n_groups")]
                places = np.concatenate([[0], np.cumsum(there)])[s.at]
                yield _row([
                    batch.column(0).slice(lo, hi - lo).to_pylist(), *_numbers(s, [*counts, links]), _digests(s), places,
                    chunk.astype(_small(len(s.known))).tobytes(), links.astype("<u4").tobytes(),
                    linked.astype(_small(len(keys))).tobytes(),
                    (keys >> ID_BITS).astype(a_kind).tobytes(), (keys & _ID).astype(b_kind).tobytes(), None, None])
                # Not held while the next slice is aligned.
                del s, there, chunk, flat, links, often, keys, linked, sums, counts, places
                if held > FLUSH_LINKS:
                    yield _row([None] * 12 + list(_folded(pairs, times)))
                    pairs, times, held = [], [], 0
        if held:
            yield _row([None] * 12 + list(_folded(pairs, times)))

    return cut_lineage(docs.mapInArrow(trimmed_stream(run), _PASS), STORED)


def pair_counts(passed: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each id pair, and whether no pair of its second id has more.

    ``pair`` is the first id times 2^32 plus the second. Pairs are added up in a task before they are sent.
    """
    each = passed.where(F.col("pair").isNotNull()).select(F.inline(F.arrays_zip("pair", "n")))
    counted = cut_lineage(each.groupBy("pair").agg(F.sum("n").alias("n")))
    second_id = F.col("pair").bitwiseAND(F.lit(_ID))
    most = counted.groupBy(second_id.alias("b")).agg(F.max("n").alias("most"))
    return counted.join(most, second_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _unpacked(batch: pa.RecordBatch, i: int, kinds: tuple) -> tuple[np.ndarray, ...]:
    """Of a stored slice: chunk of each occurrence, links per chunk, their places among the distinct pairs, these, where each text's
    occurrences begin."""
    raw = {c: batch.column(c)[i].as_py() for c in ("chunk", "links", "linked", "a", "b")}
    links = np.frombuffer(raw["links"], "<u4").astype(np.int64)
    chunk = np.frombuffer(raw["chunk"], _small(len(links))).astype(np.int64)
    pairs = np.frombuffer(raw["a"], kinds[0]).astype(np.int64) << ID_BITS | np.frombuffer(raw["b"], kinds[1]).astype(np.int64)
    linked = np.frombuffer(raw["linked"], _small(len(pairs)))
    return chunk, links, linked, pairs, batch.column("places").slice(i, 1).flatten().to_numpy()


def align(
    docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text",
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """One row per row: tokens of both tokenizers, groups between common ends, links of overlapping tokens.

    One pass over the texts stores what each gives and adds up how often each id pair is linked; then these counts are looked
    up for every link. Pairs are bounded by the product of the two vocabularies; while they are at most ``most_sent``
    (checked by a count), every task gets the table, otherwise the links of each document, folded, are joined with it.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Texts that are null, empty, or not given
    back byte for byte by both tokenizers have zeros and ''. Repeated rows and null ids are rows like others and count
    for the pairs; other columns are ignored. An empty table gives no rows.
    """
    narrow = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    passed = aligned_slices(narrow, first, second)
    counts = cut_lineage(pair_counts(passed))
    told = passed.where(F.col("chunk").isNotNull()).drop("pair", "n")
    pair = aligner(first, second)
    kinds = _small(len(pair.first.bytes)), _small(len(pair.second.bytes))
    if counts.count() <= most_sent:
        table = counts.orderBy("pair").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A worker that aligned before has no more use for what it remembers.
            aligner.cache_clear()
            trim()
            keys, n, best = sent.value
            for batch in batches:
                for i in range(len(batch)):
                    chunk, links, linked, pairs, places = _unpacked(batch, i, kinds)
                    ends = np.concatenate([[0], np.cumsum(links)])
                    # A chunk that only texts without tokens have may hold pairs that were never counted.
                    at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                    sums = []
                    for x in (best, n):
                        found = np.where(keys[at] == pairs, x[at], 0) if len(keys) else pairs * 0
                        by_chunk = np.diff(np.concatenate([[0], np.cumsum(found[linked])])[ends])
                        sums.append(np.diff(np.concatenate([[0], np.cumsum(by_chunk[chunk])])[places]))
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).slice(i, 1).flatten() for c in _OUT[:5]], *map(pa.array, sums),
                         batch.column(_OUT[-1]).slice(i, 1).flatten()], names=_OUT)

        return told.mapInArrow(trimmed_stream(look_up), RESULT)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                chunk, links, linked, pairs, places = _unpacked(batch, i, kinds)
                begins = np.cumsum(links) - links
                keys, times = [], []
                for lo, hi in zip(places[:-1], places[1:]):
                    held = chunk[lo:hi]
                    k, n = np.unique(pairs[linked[spread(begins[held], links[held])]], return_counts=True)
                    keys.append(k)
                    times.append(n)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, 1).flatten() for c in (*_OUT[:5], _OUT[-1])],
                     pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                    names=[*_OUT[:5], _OUT[-1], "pair", "times"])

    rows = cut_lineage(told.mapInArrow(trimmed_stream(fold), ROW + ", pair array<long>, times array<long>")
                       .withColumn("row", F.monotonically_increasing_id()))
    each = rows.select("row", F.inline(F.arrays_zip("pair", "times")))
    summed = each.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.drop("pair", "times").join(summed, "row", "left").select(
        *_OUT[:5], *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], _OUT[-1])


_OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
RESULT = ", ".join(f"{c} long" for c in _OUT[:-1]) + ", groups_sha256 string"
