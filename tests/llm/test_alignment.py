"""Cross-tokenizer alignment against whole texts aligned byte by byte."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from medlark.llm import alignment
from medlark.llm.queries import tokenizer_path

A, B = tokenizer_path(alignment.FIRST), tokenizer_path(alignment.SECOND)
FIRST = Tokenizer.from_file(A)
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=B)
ENTRY = {i: e for e, i in FIRST.get_vocab().items()}
OF = alignment.byte_characters()

ODD = [None, "", " ", "  ", "a\n", "\n a", "x \n  y", "a\r\nb \r c", "é😀漢字 　x  y", "a▁b", "▁", "<s>[INST] </s> <0x41> <unk>",
       "<|endoftext|> it's we'LL", "x\x00z\t\ty", "no" * 900, "  q   r", "ab\x1c cd", "ﬁ Å ①", "tail  ", "é" * 50,
       "\U0001f469‍\U0001f4bb and नमस्ते �"]


def tokens(text):
    a = FIRST.encode(" " + text, add_special_tokens=False).ids
    b = SECOND.encode(text)
    a_bytes = [bytes(OF[c] for c in ENTRY[i]) for i in a]
    b_bytes = [bytes([int(SECOND.id_to_piece(i)[3:5], 16)]) if SECOND.is_byte(i)
               else SECOND.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, b, a_bytes, b_bytes


@lru_cache(maxsize=None)
def by_hand(text):
    """(ids of both, groups as text, links) of a whole text, byte by byte."""
    if not text:
        return [], [], 0, "", []
    a, b, a_bytes, b_bytes = tokens(text)
    want = (" " + text).encode()
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return [], [], 0, "", []
    owner = [[i for i, x in enumerate(p) for _ in x] for p in (a_bytes, b_bytes)]
    links = [(a[i], b[j]) for i, j in sorted(set(zip(*owner)))]
    groups, i, j = [], 0, 0
    for k in range(1, len(want) + 1):
        if k == len(want) or owner[0][k] != owner[0][k - 1] and owner[1][k] != owner[1][k - 1]:
            x, y = owner[0][k - 1] + 1, owner[1][k - 1] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
    return a, b, len(groups), ";".join(groups), links


def expected(rows):
    done = [(i, *by_hand(t)) for i, t in rows]
    counts = Counter(p for *_, links in done for p in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(i, len(a), len(b), n, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if a else "") for i, a, b, n, g, links in done]


def given_by(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 0])
def test_whole_table(spark, sf_dir, most_sent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = given_by(alignment.align(docs, A, B, most_sent=most_sent))
    assert got == sorted(expected([(r["doc_id"], r["text"]) for r in docs.collect()]), key=str)


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 0])
def test_odd_texts(spark, odd_docs, no_docs, most_sent):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD * 2)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, pair int").repartition(3)
    assert given_by(alignment.align(docs, A, B, most_sent=most_sent)) == sorted(expected(rows), key=str)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert given_by(alignment.align(odd_docs, A, B, most_sent=most_sent)) == sorted(expected(rows), key=str)
    assert alignment.align(no_docs, A, B, most_sent=most_sent).collect() == []


def test_zeros_without_tokens(spark):
    docs = spark.createDataFrame([(1, "a▁b"), (2, None)], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align(docs, A, B).collect()} == {(0, 0, 0, 0, 0, 0, "")}


PARTS = st.sampled_from([" ", "  ", "\n", "\r", "\t", "a", "it's", "the", "é", "漢", "😀", " ", "　", "▁", "<0x0A>", "</s>", "1",
                         ".", "--", "​", "\x1c", "don't", "ing", "́", "﻿"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS | st.characters(codec="utf-8"), max_size=12).map("".join), min_size=1, max_size=5))
def test_chunks_give_what_whole_texts_give(texts):
    pair = alignment.aligner(A, B)
    assert pair.cuts
    s = alignment._aligned_slice(pa.array(texts), pair)
    for k, t in enumerate(texts):
        a, b, n, groups, links = by_hand(t)
        held = [s.known[c] for c in s.chunk[s.at[k]: s.at[k + 1]]] if s.good[k] else []
        assert (sum(h.n_a for h in held), sum(h.n_b for h in held), sum(h.n_groups for h in held)) == (len(a), len(b), n)
        assert ";".join(h.groups for h in held) == groups
        flat, _ = alignment._links(held)
        assert [(p >> 32, p & (2**32 - 1)) for p in flat.tolist()] == links


def test_tokenizers_hold_a_bounded_share_of_a_slice(monkeypatch):
    sizes, inner = [], alignment.Aligner._learn_units

    def watched(self, units):
        sizes.append(sum(len(r) for u in units for r in u))
        return inner(self, units)

    monkeypatch.setattr(alignment.Aligner, "_learn_units", watched)
    pair = alignment.Aligner(tokenizer_path(alignment.FIRST), tokenizer_path(alignment.SECOND))
    raw = [f" word{i}".encode() for i in range(60_000)]
    found = pair.align(raw)
    assert len(sizes) > 1 and max(sizes) <= alignment.LEARNED_BYTES + alignment.JOINED * max(map(len, raw))
    assert all(found[r] is not None for r in raw)


def test_stored_slices_are_small(spark):
    """Rows that JVMs copy whole and the groups of rows that they write and read at once do not grow with a task."""
    word = [f"{i * 2654435761 % 2**32:x}" for i in range(60_000)]
    texts = [" ".join(word[(i * 211 + k * k) % len(word)] for k in range(220)) for i in range(5_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    passed = alignment.aligned_slices(docs, A, B)
    assert sum(map(len, texts)) > 8 << 20
    sizes = passed.where("chunk is not null").selectExpr(
        "length(chunk) + length(links) + length(linked) + length(a) + length(b) + 8 * size(places) as n")
    assert max(r["n"] for r in sizes.collect()) < 1 << 20
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in passed.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert max(sum(g.column(i).total_compressed_size for i in range(g.num_columns)) for g in groups) < 5 << 20
