"""Registered queries against their SQL, and the pipeline against its stages done by hand."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from checker import connect, differences
from medlark.llm import mixing, packing, queries
from test_brute_force import WORD, shingle_set


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_by_hand(spark, sf_dir):
    """Each stage's rows, worked out in Python from what the stage before has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.cut_lineage(corpus_pipeline.keep_quality(spark, docs, sf_dir))
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert 0 < len(rows) < docs.count() and kept.columns == docs.columns

    sets = {d: shingle_set(r["text"]) for d, r in rows.items()}
    holders: dict[tuple, list[int]] = {}
    for d in sorted(sets):
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    up = {d: d for d in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    common = Counter((a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    single = corpus_pipeline.cut_lineage(corpus_pipeline.one_of_each_group(spark, kept, sf_dir))
    assert {r["doc_id"] for r in single.collect()} == {d for d in sets if find(d) == d}

    first: dict[tuple, int] = {}
    alone = {r["doc_id"]: r["text"] for r in single.collect()}
    for d in sorted(alone):
        w = WORD.findall(alone[d])
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i:i + 13]), d)
    cleaned = corpus_pipeline.cut_lineage(corpus_pipeline.without_repeats(spark, single, sf_dir))
    for r in cleaned.collect():
        w = WORD.findall(alone[r["doc_id"]])
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < r["doc_id"] for j in range(i, i + 13)}
        want = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else alone[r["doc_id"]]
        assert r["text"] == want and r["n_chars"] == len(want)

    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(cleaned).collect()}
    mixed = corpus_pipeline.cut_lineage(corpus_pipeline.mixed(spark, cleaned, sf_dir))
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {d: n for d, n in words.items() if n} == {d: n for d, n in taken.items() if n}

    packed = corpus_pipeline.packed(spark, mixed, sf_dir).collect()
    assert max(Counter(r["sequence_id"] for r in packed for _ in range(r["length"])).values()) <= packing.CAPACITY
    assert sum(r["piece"] == 0 for r in packed) == mixed.count()
    whole = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)
    assert whole == Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
                            for r in corpus_pipeline.run(spark, sf_dir).collect())
