"""Vector codes against rounds written out, every entry compared."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from medlark.llm import vector_codes


def by_hand(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label_error, digest) in plain loops over whole numbers."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v], label) for i, v, label in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], dtype=np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].swapaxes(0, 1).copy()

    def assigned():
        far = ((x.swapaxes(0, 1)[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        return far.argmin(axis=2), far.min(axis=2)

    for _ in range(rounds):
        code, _ = assigned()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[code[p] == e, p]
                if len(own):
                    books[p, e] = [int(s) // len(own) for s in own.sum(axis=0)]
    code, far = assigned()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    errors = far.sum(axis=0).tolist()
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    return [(i, "".join(f"{c:02x}" for c in code[:, k]), errors[k], total[label], digest) for k, (i, _, label) in enumerate(kept)]


def compare(df, rows, **how):
    got = sorted((tuple(r) for r in vector_codes.encode(df, **how).collect()), key=str)
    assert got == sorted(by_hand(rows, **how), key=str)


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    compare(df, [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


@pytest.mark.parametrize("entries, block, scale", [(7, 64, 1024), (256, 10_000, 4), (40, 500, 2**22), (1, 100, 1024)])
def test_balls_lose_no_nearer_entry(spark, monkeypatch, entries, block, scale):
    """Clustered vectors with many equal distances, equal entries and hot values."""
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(entries)
    centres = rng.integers(-6, 6, (9, 8))
    rows = [(int(rng.integers(0, 400)), (centres[rng.integers(9)] + rng.integers(-1, 2, 8) / 2).tolist(), int(rng.integers(3)))
            for _ in range(600)]
    rows += [(1000 + i, [1.0] * 8, None) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    compare(df, rows, entries=entries, scale=scale)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1, "x"), (2, [0.5, None, 1.0, 2.0], 1, "x"), (3, [nan, 0.0, 0.0, 0.0], 2, "x"), (4, [inf, 0.0, 0.0, 0.0], 2, "x"),
            (5, [], 2, "x"), (6, [-0.0001, 0.2, -3.0, 9.0], None, "x"), (6, [-0.0001, 0.2, -3.0, 9.0], None, None),
            (6, [0.0, 0.2, -3.0, 9.0], 3, "x"), (None, [7.0, 7.0, 7.0, 7.0], None, "x"), (-1, [7.0, 7.0, 7.0, 7.0], 3, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string")
    compare(df, [r[:3] for r in rows])
    compare(df, [r[:3] for r in rows], entries=2)
    empty = vector_codes.encode(df.limit(0))
    assert empty.collect() == [] and empty.columns == vector_codes.encode(df).columns
    assert vector_codes.encode(df.where("vec_id < 6 and vec_id > 0")).collect() == []
    for bad in ([1.0, 2.0], [1.0] * 8, [1e6] * 4):
        with pytest.raises(ValueError):
            vector_codes.encode(df.unionByName(spark.createDataFrame([(9, bad, 1, "x")], df.schema)))


def test_stable_cores_are_not_compared():
    """Far balls: rows near their own entry need no other; the rest see only the neighbours their ring reaches."""
    entries = np.array([[0.0, 0.0], [10.0, 0.0], [100.0, 0.0], [103.0, 0.0]])
    balls, seen = vector_codes.Balls(entries), []
    whole = balls._nearest_of
    balls._nearest_of = lambda x, among: (seen.append((len(x), among.tolist())), whole(x, among))[1]
    x = np.array([[1.0, 0.0], [6.0, 0.0], [100.0, 1.0], [102.0, 0.0]])
    code, far = balls.renewed(x, np.array([0, 0, 2, 2]))
    assert code.tolist() == [0, 1, 2, 3] and far.tolist() == [1.0, 16.0, 1.0, 1.0]
    assert seen == [(1, [0, 1]), (1, [2, 3])]
