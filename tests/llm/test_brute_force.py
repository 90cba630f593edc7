"""Operators against brute force, and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter
from math import ceil, log

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medlark.llm import (
    common, components, exchange, extraction, fingerprints, mixing, ngram_join, packing, quality, queries, sharding,
    substrings, toxicity, warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def spark_hash(*parts, seed=42):
    for p in parts:
        seed = xxhash.xxh64_intdigest(struct.pack("<i", p) if isinstance(p, int) else p.encode(), seed=seed)
    return seed


# --- sharding -----------------------------------------------------------------

@pytest.mark.parametrize("shards, per_bucket", [(24, 10_000), (7, 20), (3, 1)])
def test_shards_have_the_mixture(docs, texts, shards, per_bucket):
    rows = sharding.interleave(docs, shards, rows_per_bucket=per_bucket).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(rows) == len(texts)
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    sources = Counter(r["source"] for r in rows)
    for (s, source), n in Counter((r["shard"], r["source"]) for r in rows).items():
        assert abs(n - sources[source] * sizes[s] / len(rows)) <= 2
    assert all(zlib.crc32(texts[r["doc_id"]].encode()) == r["text_crc32"] for r in rows)


def test_order_of_shards_is_the_fractional_rank(docs):
    one = sharding.interleave(docs, 1).collect()
    by_slot = [r["source"] for r in sorted(one, key=lambda r: r["slot"])]
    seen, total = Counter(), Counter(by_slot)
    ranks = []
    for s in by_slot:
        seen[s] += 1
        digest = hashlib.sha256(f"shards-phase|{'null' if s is None else s}".encode()).hexdigest()
        ranks.append((seen[s] - 1 + int(digest[:15], 16) / 2**60) / total[s])
    assert ranks == sorted(ranks)


@pytest.mark.parametrize("each", [1, 2, 5])
def test_sources_of_few_rows_are_spread(spark, each):
    n = 6_000
    few = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.expr(f"cast(id div {each} as string)").alias("source"))
    rows = sharding.interleave(few, 6, rows_per_bucket=200).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == n and set(sizes.values()) == {n // 6}
    # The ranges that windows run in: none above twice the mean.
    u = few.groupBy("source").count().select(sharding.phase("shards", F.col("source")).alias("u"), "count").collect()
    ranges = n // 200 + 1
    held = Counter(int((k + r["u"]) / r["count"] * ranges) for r in u for k in range(r["count"]))
    assert max(held.values()) < 2 * n / ranges


# --- packing ------------------------------------------------------------------

def test_pieces_are_the_tokens(docs, texts):
    rows = packing.pack(docs, queries.tokenizer_path(), rows_per_bucket=50).collect()
    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: [*e.ids, 0] for d, e in zip(texts, tok.encode_batch(list(texts.values()), add_special_tokens=False))}
    held: dict[int, list] = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["start"] == 2048 * r["piece"] and (r["length"] == 2048 or r["start"] + r["length"] == len(ids[r["doc_id"]]))
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for parts in held.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == list(ends[:-1]) and ends[-1] <= 2048
    assert len(held) <= ceil(sum(map(len, ids.values())) / 2048) + 2


@pytest.mark.parametrize("text", [
    "it's don''t 'S can't''", "<|endoftext|> a<|startoftext|>.", "İstanbul ΣΣ. näive é!", "a\u0000b 　 x y ...",
    "ABC123abc!!! 12,5% \U0001f600\U0001f600", "''' \" ''s s'", "中文，字 กำ. ́a",
])
def test_tokens_of_words_are_those_of_the_text(text):
    import pyarrow as pa

    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids, at = packing.token_ids(pa.array([text, None, text]), queries.tokenizer_path())
    want = [*tok.encode(text, add_special_tokens=False).ids, 0]
    assert ids.tolist() == want + [0] + want and at.tolist() == [0, len(want), len(want) + 1, 2 * len(want) + 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    counts = Counter(lengths)
    length, rank, sequence, offset = packing.plan(dict(counts), 40)
    slots = sorted(zip(length.tolist(), rank.tolist(), sequence.tolist(), offset.tolist()))
    used: dict[int, set] = {}
    for n in counts:
        own = [s for s in slots if s[0] == n]
        assert own[0][1] == 0
        for (_, a, first, at), end in zip(own, [s[1] for s in own[1:]] + [counts[n]]):
            for i in range(end - a):
                cells = set(range(at, at + n))
                assert not cells & used.setdefault(first + i, set()) and at + n <= 40
                used[first + i] |= cells
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= n]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(40 - n)
    assert len(used) == len(rooms)


# --- WARC ---------------------------------------------------------------------

def test_index_finds_exactly_the_captures_of_a_key(spark, tmp_path):
    rows = [(f"k{i % 40:02d}", i, "f", i, i) for i in range(1000)] + [("k05", 1000 + i, "f", i, i) for i in range(900)]
    captures = spark.createDataFrame(rows, warc.CAPTURE)
    folder = f"file://{tmp_path}/index"
    index = warc.build_index(captures, folder, file_lines=150, block_lines=7)
    assert index.count() > 8
    keys = spark.createDataFrame([("k05",), ("k39",), ("nowhere",), ("",), ("zzz",)], "key string")
    got = [tuple(r) for r in warc.look_up(keys, index, folder).collect()]
    assert sorted(got) == sorted(r for r in rows if r[0] in ("k05", "k39"))


# --- toxicity -----------------------------------------------------------------

def test_held_out_labels_are_found(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hits = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert sum(hits) / len(hits) > 0.85
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) / len(rows) < 0.01


def test_label_model_tells_voters_apart():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    sign = np.where(truth, 1, -1)
    flip = lambda p: np.where(rng.random(4000) < p, sign, -sign)
    good, fair, coin = flip(0.9), flip(0.75), flip(0.5)
    votes = np.column_stack([good, fair, coin, coin, coin, flip(0.8), flip(0.97)]).astype(np.int8)
    model = toxicity.fit_label_model(votes, 0.3)
    accuracy = (model.table[1, :, 2] + model.table[0, :, 0]) / 2
    assert abs(accuracy[0] - 0.9) < 0.05 and abs(accuracy[1] - 0.75) < 0.05 and abs(accuracy[2] - 0.5) < 0.05
    assert model.discount[2] < 0.45 < model.discount[0]
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


# --- quality ------------------------------------------------------------------

def test_counts_and_ratio_are_brute_force(spark, docs, texts, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    good = {r["doc_id"] for r in labels.collect()}

    def grams(words):
        out = [spark_hash(1, w) for w in words] + [spark_hash(2, a, b) for a, b in zip(words, words[1:])]
        return [h % quality.BUCKETS for h in out + [spark_hash(3, w[-3:]) for w in words]]

    held = {d: grams(WORD.findall(t)) for d, t in texts.items()}
    raw, trusted = Counter(), Counter()
    for d, g in held.items():
        raw.update(g)
        trusted.update(g if d in good else [])
    share, k = sum(trusted.values()) / sum(raw.values()), quality.SMOOTHING
    weight = {b: log((trusted[b] + k) / (n * share + k)) for b, n in raw.items()}
    for r in quality.quality_rules(docs, labels).collect():
        text = texts[r["doc_id"]]
        words = WORD.findall(text)
        places: dict[tuple, list[int]] = {}
        for i in range(len(words) - 2):
            places.setdefault(tuple(words[i:i + 3]), []).append(i)
        covered = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert (r["n_symbols"], r["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        ratio = sum(weight[b] for b in held[r["doc_id"]]) / max(1, len(held[r["doc_id"]]))
        assert r["ratio"] == pytest.approx(ratio, abs=1e-9)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r["base_failed"] == failed and r["kept"] == (not failed and ratio >= quality.LEAST_RATIO)


def test_labelled_documents_are_told_apart(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality_rules(docs, labels.where("quality = 1")).join(labels, "doc_id").collect()
    rows = [r for r in rows if not r["base_failed"]]
    assert all(r["kept"] == (r["quality"] == 1) for r in rows)


# --- n-gram join --------------------------------------------------------------

def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text)]
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


@pytest.mark.parametrize("block_documents", [2_000, 6])
def test_components_are_brute_force(spark, block_documents):
    rng = random.Random(3)
    rows, base = [], []
    for i in range(160):
        if i % 4 == 0 or not base:
            base.append([f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 40, 90]))])
        words = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
        rows.append((i, " ".join(words) + (" " + " ".join(f"common{k}" for k in range(12)) if i % 3 == 0 else "")))
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), block_documents=block_documents)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == \
        {i: (len(s), find(i)) for i, s in sets.items()}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000))
def test_signature_tree_is_brute_force(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(rng.integers(1, 60)):
        if sets and rng.random() < 0.6:
            s = sets[rng.integers(len(sets))]
            s = np.append(s[rng.random(len(s)) < 0.93], rng.integers(1 << 60, size=rng.integers(0, 4), dtype=np.uint64))
        else:
            s = rng.integers(1 << 60, size=rng.integers(1, 120), dtype=np.uint64)
        sets.append(np.unique(s.astype(np.uint64)))
    up = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            union = len(sets[i]) + len(sets[j]) - common
            if union and 100 * common >= 75 * union:
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    assert ngram_join.tree_components(sets).tolist() == up


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(3, 3), (7, 5), (5, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, 7, *range(1000, 1200)]}}


# --- fingerprints -------------------------------------------------------------

def simhash(text):
    words = WORD.findall(text)
    terms = [(spark_hash(a, b), min(15, len(a.encode()) + len(b.encode()))) for a, b in zip(words, words[1:])]
    terms = terms or [(spark_hash(w), 1) for w in words]
    total = sum(w for _, w in terms)
    return sum(1 << j for j in range(64) if 2 * sum(w for h, w in terms if h >> j & 1) > total)


def test_fingerprints_and_edits_are_brute_force(docs, texts):
    few = {d: texts[d] for d in sorted(texts)[:120]}
    ids = sorted(few, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    rows = fingerprints.edit_likeness(docs.where(f"doc_id <= {max(few)}"), rows_per_range=13).collect()
    prints = {d: simhash(t) for d, t in few.items()}
    assert len(rows) == len(few)
    for r in rows:
        text, after = few[r["doc_id"]], few[following[r["doc_id"]]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, new = prints[r["doc_id"]], simhash(edited)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(text)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{own:016x}", f"{new:016x}")
        assert r["near_edited"] == 1 - (own ^ new).bit_count() / 64
        assert r["near_next"] == 1 - (own ^ prints[following[r["doc_id"]]]).bit_count() / 64


@pytest.mark.parametrize("per_range", [3, 20, 8_000])
def test_next_rows_when_ids_are_null_or_shared(spark, per_range):
    rng = random.Random(per_range)
    ids = [None] * 90 + [7] * 60 + [8] * 2 + [-(2**62), 2**63 - 1, -5, 0] + list(range(100, 250))
    rows = [(d, f"text {i} of {rng.randrange(9)}") for i, d in enumerate(ids)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(spark_hash(r[1]))))
    want = {r: after[1] for r, after in zip(order, order[1:] + order[:1])}
    got = fingerprints.with_next(frame, rows_per_range=per_range).collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["text"]): r["next_text"] for r in got} == want


def test_plan_does_not_grow_with_ranges(spark):
    frame = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    sizes = [len(fingerprints.with_next(frame, rows_per_range=n)._jdf.queryExecution().analyzed().toString()) for n in (1_000, 2)]
    assert sizes[1] - sizes[0] < 40_000


def test_neighbours_of_asking_documents_are_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.likeness_and_neighbours(docs, 20).collect()}
    prints = {d: int(r["fingerprint"], 16) for d, r in got.items()}
    assert set(got) == set(texts)
    for d, r in got.items():
        near = sum((prints[d] ^ p).bit_count() <= 3 for p in prints.values())
        assert r["n_near"] == (near if d % 20 == 0 else None)
    assert max(r["n_near"] or 0 for r in got.values()) > 1


@pytest.mark.parametrize("radius, blocks", [(3, 6), (0, 1), (2, 3), (5, 7)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(30)]
    every = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2**64 - 1) for b in base for _ in range(8)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(x),) for x in every] + [(None,)], "fingerprint long")
    asked = spark.createDataFrame([(signed(x),) for x in base], "fingerprint long")
    got = [(r["query"], r["fingerprint"], r["distance"])
           for r in fingerprints.within_radius(asked, frame, radius, blocks).collect()]
    want = {(signed(q), signed(x), (q ^ x).bit_count()) for q in base for x in every if (q ^ x).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


# --- extraction ---------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li><li><a href="/b">More</a></ul></nav><div class="cookie-notice">We use cookies to serve you.</div>
<aside>Side story told in some words here</aside><article class=main><h1>The &amp;  title</h1><!-- ad --><p><b>First   paragraph<br>goes on
&lt;here&gt;.<p>Second <a href="x">linked</a> one &copy; 5 &am
<div class="ad">Buy now, all of it, today and tomorrow too.</div><form><p>Your name <input name=n></p></form>
<p>Third.</p><section id="comments"><p>I do not like this article at all, says a reader.</p></section></article>
<footer>&copy; all of us</footer><p unclosed"""


def test_article_of_a_page():
    assert extraction.main_text(PAGE) == \
        "The & title\nFirst paragraph goes on <here>.\nSecond linked one © 5 &am\nThird."


def _said(n: int, mark: str) -> str:
    return " ".join(f"{mark}{i}" for i in range(n))


def test_pages_of_divs_keep_all_their_text():
    menu = "".join(f'<li><a href="/{i}">menu{i}</a></li>' for i in range(5))
    for sizes in ([100] * 5, [200] * 9, [70, 30, 150, 25, 90, 66], [40, 36, 300, 21, 80]):
        said = [_said(n, f"p{i}w") for i, n in enumerate(sizes)]
        for tag in ("div", "p"):
            body = "".join(f"<{tag}>{x}</{tag}>" for x in said)
            assert extraction.main_text(f"<body><div><ul>{menu}</ul></div><div>{body}</div></body>").split("\n") == said


@pytest.mark.parametrize("n, size", [(1, 3), (1, 18), (4, 2), (6, 5), (9, 12)])
def test_short_blocks_between_long_ones_are_kept(n, size):
    said = [_said(90, "a"), *[_said(size, f"i{i}w") for i in range(n)], _said(80, "b"), _said(70, "c")]
    items = "".join(f"<li>{x}</li>" for x in said[1:-2])
    page = f"<div>{said[0]}</div><ul>{items}</ul><div>{said[-2]}</div><div>{said[-1]}</div>"
    assert extraction.main_text(page).split("\n") == said


def test_asides_and_lists_of_links_are_left_out():
    a, b, c = _said(90, "a"), _said(80, "b"), _said(70, "c")
    for n in (5, 30, 120):
        page = f'<div>{a}</div><aside>{_said(n, "x")}</aside><div>{b}</div><div class="ad">{_said(n, "y")}</div><div>{c}</div>'
        assert extraction.main_text(page).split("\n") == [a, b, c]
    links = "".join(f'<li><a href="/{i}">{_said(4, f"l{i}w")}</a></li>' for i in range(6))
    for tag in ("article", "main"):
        assert extraction.main_text(f"<{tag}><p>{a}</p><ul>{links}</ul><p>{b}</p></{tag}>").split("\n") == [a, b]
        linked = f'<a href="/x">{_said(6, "k")}</a>'
        assert extraction.main_text(f"<{tag}><p>{a}</p><p>{linked}</p><p>{b}</p></{tag}>").split("\n") == [a, _said(6, "k"), b]


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><article>{}</article></body>', '<body class="no-sidebar search"><article>{}</article></body>',
    '<html id=search><body><main class="comment">{}</main></body></html>', '<article class="post comment-closed">{}</article>',
    '<article data-id="share">{}</article>', '<article><div data-class="ad" aria-role=menu>{}</div></article>',
    '<article><div id="related-work">{}</div></article>', '<article><div title="id=share">{}</div></article>',
    '<div class="widget"><article>{}</article></div>', '<form id=form1><main>{}</main></form>',
    '<main><h1 class="section-header">A title</h1></main><div class="sidebar"><article>{}</article></div>',
])
def test_names_of_wrappers_do_not_lose_the_article(page):
    said = [_said(60, "a"), _said(6, "b"), _said(40, "c")]
    text = extraction.main_text(page.format("".join(f"<p>{x}</p>" for x in said))).split("\n")
    assert text[-3:] == said


def test_headings_are_not_aside_by_their_class():
    page = f'<article><h2 class="section-header header" id="related">On words</h2><p>{_said(30, "a")}</p></article>'
    assert extraction.main_text(page) == f'On words\n{_said(30, "a")}'


@pytest.mark.parametrize("mark", [
    'class="box ad"', "class=AD", "id='comments'", "role=navigation", 'class="cookie-notice"', 'ID="site_footer"',
    'data-id="x" class="x\nsidebar"', 'class="a&#32;ad"'])
def test_marked_elements_are_aside(mark):
    a, b = _said(50, "a"), _said(40, "b")
    for inner in ("{}", "<article class=comment>{}</article>", "<article>{}</article>"):
        page = f'<article><p>{a}</p><div {mark}>{inner.format(_said(30, "x"))}</div><p>{b}</p></article>'
        assert extraction.main_text(page).split("\n") == [a, b]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="<>/=\"'pabr! -&;scit\n", max_size=80))
def test_any_page_can_be_read(html):
    text = extraction.main_text(html)
    assert text == text.strip() and "\n\n" not in text


# --- mixing -------------------------------------------------------------------

def test_mixture_comes_near_its_targets(docs):
    rows = mixing.mix(docs, rows_per_bucket=20).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(rows) == sorted(again)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))


def test_mixed_rows_have_the_words_taken(docs):
    taken = mixing.mix(docs)
    want = {r["doc_id"]: r["taken"] for r in taken.collect()}
    got = Counter()
    for r in mixing.apply_mix(docs, taken).collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {d: n for d, n in want.items() if n} == {d: n for d, n in got.items() if n}


# --- substring dedup ----------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_repeats_are_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(passages) if rng.random() < 0.5 else [rng.choice("aab") for _ in range(rng.randrange(30))]
            words += part[rng.randrange(3):] + [f"u{rng.randrange(1000)}"] * rng.randrange(20)
        rows.append((rng.randrange(10_000), " ".join(words)))
    rows = list({d: (d, t) for d, t in rows}.values())
    first: dict[tuple, int] = {}
    for d, t in rows:
        w = t.split()
        for i in range(len(w) - 12):
            first[tuple(w[i:i + 13])] = min(d, first.get(tuple(w[i:i + 13]), d))
    for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        w = r["text"].split()
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < r["doc_id"] for j in range(i, i + 13)}
        assert r["n_removed"] == len(gone)
        assert r["kept"] == " ".join(x for j, x in enumerate(w) if j not in gone)


def test_equal_windows_have_equal_inner_symbols():
    rng = np.random.default_rng(0)
    import pyarrow as pa

    shared = [f"w{i}" for i in rng.integers(0, 9, 40)]
    texts = [" ".join([f"x{i}" for i in rng.integers(0, 50, n)] + shared + [f"y{i}" for i in rng.integers(0, 50, 30)])
             for n in (0, 7, 20)]
    words = common.Words(pa.array(texts))
    names, _ = substrings.word_hashes(words)
    text, left, right, h = substrings._inner(names, words, 13)
    found = []
    for i, n in enumerate((0, 7, 20)):
        at = words.offsets[i] + n
        mine = (text == i) & (left >= at) & (right <= at + 40)
        found.append(set(zip((left[mine] - at).tolist(), h[mine].tolist())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 8


# --- exchange -----------------------------------------------------------------

@pytest.mark.parametrize("folded", [True, False])
def test_exchange_finds_shared_keys(spark, folded):
    rng = random.Random(5)
    held = {d: {rng.randrange(3000) for _ in range(40)} | ({7} if d % 3 == 0 else set()) for d in range(-50, 150)}
    df = spark.createDataFrame([(d, sorted(k)) for d, k in held.items()], "doc_id long, k array<long>").repartition(5)

    def pairs(batch):
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        flat = exchange.mix(np.array([k for ks in keys for k in ks], np.uint64))
        yield np.repeat(ids, [len(k) for k in keys]).astype(np.int64), exchange.place(flat, 11), len(ids)

    rows = df.mapInArrow(lambda b: exchange.gather(b, pairs, folded), exchange.ROW)
    got: dict[int, set] = {}
    for r in exchange.shared_keys(rows, 13, with_counts=not folded).collect():
        keys = np.frombuffer(r["keys"], np.int64).tolist()
        assert len(keys) == r["n"]
        got.setdefault(r["doc_id"], set()).update(keys)
    n = Counter(k for ks in held.values() for k in ks)
    placed = {k: int(exchange.place(exchange.mix(np.array([k], np.uint64)), 11)[0]) for k in n}
    assert got == {d: {placed[k] for k in ks if n[k] > 1} for d, ks in held.items()}


# --- pages of other layouts ---------------------------------------------------

def _sentence(n, w):
    return " ".join(f"{w}{i}" for i in range(n)) + "."


def test_a_page_laid_out_in_a_form_keeps_its_text():
    said = [_sentence(n, "w") for n in (60, 12, 70)]
    inside = "".join(f"<p>{s}</p>" for s in said)
    menu = "<nav><ul><li><a href=/>home page</a></li></ul></nav>"
    page = f'<body><form id="aspnetForm">{menu}<div><h1>On words</h1>{inside}</div><input name=q></form></body>'
    assert extraction.main_text(page).split("\n") == ["On words", *said]
    # A form beside an article is its fields.
    asked = "<form><p>Your name please</p><label>Mail</label></form>"
    assert extraction.main_text(f"<body><article>{inside}</article>{asked}</body>").split("\n") == said
    assert extraction.main_text(f"<body><div>{inside}</div>{asked}</body>").split("\n") == said


def test_an_apostrophe_in_an_attribute_opens_no_quotation():
    said = [_sentence(30, w) for w in "abc"]
    page = f"<article><p title=it's>{said[0]}</p><p data-x=\"a>b\">{said[1]}</p><p title='x>y' y=z'>{said[2]}</p></article>"
    assert extraction.main_text(page).split("\n") == said


def test_the_header_of_an_article_keeps_title_and_lead():
    lead, body = _sentence(25, "l"), _sentence(50, "b")
    page = f"<header><h1>Site</h1></header><article><header><h1>Title</h1><p>{lead}</p><p>Share</p></header><p>{body}</p></article>"
    assert extraction.main_text(page).split("\n") == ["Title", lead, body]


@pytest.mark.parametrize("mark", ['class="user-comment"', 'id="disqus_thread"', 'class="wp-block-comments"', 'class="cc-window"'])
def test_comments_and_notices_by_compound_names(mark):
    body, said = _sentence(50, "b"), _sentence(40, "c")
    assert extraction.main_text(f"<article><p>{body}</p></article><div {mark}><p>{said}</p></div>") == body
    assert extraction.main_text(f'<div class="post no-comments"><p>{body}</p></div>') == body


def test_time_grows_with_the_page_not_with_its_nesting():
    def seconds(n):
        page = "<div>" * n + "<b>x</b></i>" * n + "<p>y" * n
        start = time.process_time()
        extraction.blocks(page)
        return time.process_time() - start

    seconds(1000)
    small, large = min(seconds(8_000) for _ in range(3)), min(seconds(64_000) for _ in range(2))
    assert large < 24 * small
