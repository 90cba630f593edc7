"""Every operator on odd rows and on empty tables."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest

from medlark.llm import (
    extraction, fingerprints, mixing, ngram_join, packing, quality, sharding, substrings, toxicity, warc,
)
from medlark.llm.queries import tokenizer_path

OPERATORS = {
    "sharding": lambda d, m: sharding.interleave(d, 4),
    "toxicity": lambda d, m: toxicity.score_toxicity(d, m),
    "quality": lambda d, m: quality.quality_rules(d, m.where("quality = 1")),
    "ngram_join": lambda d, m: ngram_join.join_components(d),
    "fingerprints": lambda d, m: fingerprints.likeness_and_neighbours(d),
    "mixing": lambda d, m: mixing.mix(d),
    "substrings": lambda d, m: substrings.remove_repeats(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_row(odd_docs, no_docs, marks, name):
    rows = OPERATORS[name](odd_docs, marks).collect()
    ids = sorted((r["doc_id"] for r in odd_docs.collect()), key=str)
    assert sorted((r["doc_id"] for r in rows), key=str) == ids
    assert OPERATORS[name](no_docs, marks).collect() == []


def test_packing_of_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, tokenizer_path(), capacity=64).collect()
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    assert packing.pack(no_docs, tokenizer_path()).collect() == []


def test_results_of_odd_rows(odd_docs, marks):
    got = {r["doc_id"]: r for r in ngram_join.join_components(odd_docs).collect()}
    assert [got[i]["n_shingles"] for i in (1, 2, 3, 4, 11)] == [0, 0, 0, 1, 1]
    assert got[6]["component_id"] == 5 and got[10]["component_id"] == 8 and got[9]["component_id"] == 8
    assert got[14]["component_id"] == 13 and got[15]["component_id"] == 15 and got[None]["component_id"] is None
    kept = ngram_join.keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 11, 12, 13, 15]
    repeats = {r["doc_id"]: r for r in substrings.remove_repeats(odd_docs).collect()}
    assert repeats[6]["n_removed"] == repeats[6]["n_words"] == 60_000 and repeats[5]["n_removed"] == 0
    assert repeats[15]["n_removed"] == 40 and repeats[None]["n_removed"] == 0 and repeats[11]["n_removed"] == 0
    mixed = mixing.mix(odd_docs)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed.collect())
    judged = {r["doc_id"]: r for r in quality.quality_rules(odd_docs, marks.where("quality = 1")).collect()}
    assert judged[1]["base_failed"] and judged[1]["ratio"] == 0 and judged[12]["n_symbols"] == 8
    assert judged[12]["n_dup_lines"] == 1 and judged[11]["n_repeat_words"] == 400
    fitted = quality.keep_good(odd_docs, marks.where("quality = 1"))
    assert fitted.columns == odd_docs.columns
    assert {r["doc_id"] for r in fitted.collect()} == {i for i, r in judged.items() if r["kept"]}


def test_mixture_of_null_and_repeated_ids(spark, odd_docs, no_docs):
    words = lambda rows: Counter(w for r in rows for w in re.findall("[^\\x20\\x09-\\x0D]+", r["text"] or ""))
    many = spark.createDataFrame(
        [(None if i % 3 == 0 else i // 2, f"t{i} " * (1 + i % 7), "en", "ab"[i % 2], 9) for i in range(300)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (many, odd_docs):
        plan = mixing.mix(docs).collect()
        assert sum(r["taken"] for r in plan) == round(1.5 * sum(r["size"] for r in plan))
        got = corpus_pipeline.mixed(spark, docs, "").collect()
        assert words(got).total() == sum(r["taken"] for r in plan)
        # Only words of texts there are, none more often than twice its number.
        given = words(docs.collect())
        assert all(n <= 2 * given[w] for w, n in words(got).items())
        assert Counter(r["text"] for r in got if not (r["text"] or "").strip()) == \
            Counter(r["text"] for r in docs.collect() if not (r["text"] or "").strip())
        with pytest.raises(ValueError):
            mixing.apply_mix(docs, mixing.mix(docs))
    assert corpus_pipeline.mixed(spark, odd_docs, "").columns == odd_docs.columns
    assert corpus_pipeline.mixed(spark, no_docs, "").collect() == []


def test_rows_without_any_label(odd_docs, marks):
    for labels in (marks.limit(0), marks.where("toxic = 1")):
        assert {r["score"] for r in toxicity.score_toxicity(odd_docs, labels).collect()} == {0.0}
    assert all(r["ratio"] == 0 for r in quality.quality_rules(odd_docs, marks.limit(0)).collect())


def test_pages(spark, tmp_path):
    big = "<p>" + "word " * 50_000 + "</p>"
    rows = [(1, "http://b.a/x", "y" * 200, 1), (2, "http://b.a/x", "y" * 200, 1), (2, "http://b.a/x", "y" * 200, 1),
            (3, None, None, 1), (4, "", "", 1), (5, "http://B.a:80/x?q#z", "short", 1), (6, "HTTPS://u@b.a", "short", 1),
            (None, "http://c/\t\n", "y" * 200, 1), (7, "no url at all", big, 1), (8, "http://b.a/x", "y" * 199, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key int")
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"])
                  for r in warc.archive_round_trip(pages, f"file://{tmp_path}/w").collect()), key=str)
    assert got == sorted([(1, "response", None, 200), (2, "revisit", 1, 200), (2, "revisit", 1, 200), (3, "response", None, 0),
                          (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5),
                          (0, "revisit", 1, 200), (7, "response", None, len(big)), (8, "response", None, 199)], key=str)
    assert warc.archive_round_trip(pages.limit(0), f"file://{tmp_path}/v").collect() == []
    texts = {r["page_id"]: r for r in extraction.extract(pages).collect()}
    assert texts[3]["text"] == texts[4]["text"] == "" and texts[7]["n_chars"] == 5 * 50_000 - 1
    assert extraction.extract(pages.limit(0)).collect() == []
