"""Exact quantiles with linear interpolation, without sorting the table.

``percentile`` keeps every distinct value of the column in the memory of one
task. Here a sketch gives a bracket around each wanted rank, one count job
checks the bracket, and just the values strictly inside it are looked at. The
count makes the answer exact whatever the sketch error was: a rank outside its
bracket reopens the bracket, and a bracket that is still too full is narrowed
by another sketch over its inside.

Columns are unpivoted to (column number, value), so the number of jobs and the
size of the generated code do not grow with the number of columns.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.types import col

# Most values one bracket may hold before it is picked from directly.
PICK_LIMIT = 100_000
SKETCH_ACCURACY = 10_000
_MARGIN = 2.0 / SKETCH_ACCURACY
_GRID = 100


@dataclass
class _Bracket:
    """Open ranks of column ``i`` thought to lie in ``lo..hi``."""

    i: int
    lo: float
    hi: float
    ranks: list[int] = field(default_factory=list)


def exact_quantiles(
    df: DataFrame, columns: list[str] | dict[str, Column], probs: list[float],
    pick_limit: int = PICK_LIMIT,
) -> dict[str, list[float | None]]:
    """``{name: [quantile per prob]}``; ``None`` where a column has no value.

    Nulls and NaN are skipped. Every job is one scan with partial aggregates;
    what comes back is a row per column and bracket.
    """
    return {c: q for c, (_, q) in counts_and_quantiles(df, columns, probs, pick_limit).items()}


def counts_and_quantiles(
    df: DataFrame, columns: list[str] | dict[str, Column], probs: list[float],
    pick_limit: int = PICK_LIMIT,
) -> dict[str, tuple[int, list[float | None]]]:
    """As :func:`exact_quantiles`, each with the number of values of the column."""
    def wanted(name: str, n: int) -> list[tuple[int, float]]:
        return [(k, p) for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    if not isinstance(columns, dict):
        columns = {c: col(c) for c in columns}
    found = _order_statistics(df, columns, probs, wanted, pick_limit)[0]
    out: dict[str, tuple[int, list[float | None]]] = {}
    for name, (n, values) in found.items():
        quantiles: list[float | None] = [None] * len(probs)
        for j, p in enumerate(probs if n else []):
            a, b, pos = values[2 * j], values[2 * j + 1], p * (n - 1)
            quantiles[j] = a if a == b else a + (b - a) * (pos - math.floor(pos))
        out[name] = (n, quantiles)
    return out


def _between(values: list[float], pos: float) -> float:
    """Linear between the values at the ranks around ``pos``."""
    a, b = values
    return a if a == b else a + (b - a) * (pos - math.floor(pos))


def profile(
    df: DataFrame, columns: dict[str, Column], probs: list[float], more: dict[str, Callable[[Column], Column]],
    pick_limit: int = PICK_LIMIT,
) -> dict[str, tuple[int, list[float | None], dict]]:
    """``{name: (count, quantiles, further aggregates)}``; the aggregates come out of the first of the quantiles' jobs."""
    def wanted(name: str, n: int) -> list[tuple[int, float]]:
        return [(k, p) for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    found, told = _order_statistics(df, columns, probs, wanted, pick_limit, more)
    return {c: (n, [_between(v[2 * j:2 * j + 2], p * (n - 1)) if n else None for j, p in enumerate(probs)], told[c])
            for c, (n, v) in found.items()}


@dataclass
class Filled:
    """A column after its nulls became its median: figures worked out from those of its values."""

    n: int
    rows: int
    median: float | None
    quantiles: list[float | None]
    mean: float | None
    squares: float | None  # sum of squared gaps from the mean
    lo: float | None
    hi: float | None

    @property
    def std(self) -> float | None:
        return math.sqrt(self.squares / (self.rows - 1)) if self.n and self.rows > 1 else None


def filled_with_median(
    df: DataFrame, cols: list[str], probs: list[float], missing: dict[str, float] | None = None,
    pick_limit: int = PICK_LIMIT,
) -> dict[str, Filled]:
    """Exact median of every column, and the quantiles and moments it has once its nulls are the median, without filling it.

    The fills stand together right after the lower middle value, so each rank of the filled column is a known
    rank of the values, or the median itself. ``missing`` shares, if known, tell the first job where to look; they
    change no result.
    """
    def around(n: int) -> tuple[int, int]:
        return math.floor((n - 1) / 2), math.ceil((n - 1) / 2)

    rows: dict[str, int] = {}

    def places(n: int, p: float) -> list[int | None]:
        """Ranks among the values of the two ranks around ``p`` of the filled column; None: the median."""
        total, low = rows["n"], around(n)[0]
        out = []
        for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1))):
            out.append(r if r <= low else None if r <= low + total - n else r - (total - n))
        return out

    def wanted(name: str, n: int) -> list[tuple[int, float]]:
        if name == _ROWS:
            rows["n"] = n
            return []
        ranks = [*around(n), *[r for p in probs for r in places(n, p) if r is not None]]
        return [(r, r / max(1, n - 1)) for r in ranks]

    # The rows themselves are counted as one more column, the first.
    columns = {_ROWS: F.lit(0.0), **{c: col(c) for c in cols}}
    look = {0.5}
    for gone in set((missing or {}).values()) or {0.0}:
        have = 1 - gone
        look |= {p / have if p <= have / 2 else (p - gone) / have for p in probs if not have / 2 < p <= have / 2 + gone} \
            if have > 0 else set()
    found, told = _order_statistics(df, columns, sorted(look), wanted, pick_limit, {"mean": F.avg, "var": F.var_pop, "lo": F.min, "hi": F.max})
    total = rows.get("n", 0)
    out = {}
    for c in cols:
        n, values = found[c]
        if not n:
            out[c] = Filled(0, total, None, [None] * len(probs), None, None, None, None)
            continue
        at = dict(zip([r for r, _ in wanted(c, n)], values))
        median = _between([at[r] for r in around(n)], (n - 1) / 2)
        quantiles = [_between([median if r is None else at[r] for r in places(n, p)], p * (total - 1)) for p in probs]
        t, gone = told[c], total - n
        mean = (n * t["mean"] + gone * median) / total
        squares = n * t["var"] + n * (t["mean"] - mean) ** 2 + gone * (median - mean) ** 2
        out[c] = Filled(n, total, median, quantiles, mean, squares, t["lo"], t["hi"])
    return out


_ROWS = "\0rows"


def order_statistics(
    df: DataFrame, columns: dict[str, Column], ranks: dict[str, list[int]], sizes: dict[str, int],
    pick_limit: int = PICK_LIMIT,
) -> dict[str, list[float]]:
    """The values at 0-based ``ranks`` of columns with ``sizes`` values."""
    at = {c: [(r, r / max(1, sizes[c] - 1)) for r in ranks[c]] for c in columns}
    probs = [p for ranked in at.values() for _, p in ranked]
    found = _order_statistics(df, columns, probs, lambda name, _: at[name], pick_limit)[0]
    return {c: values for c, (_, values) in found.items()}


def _long(df: DataFrame, columns: list[Column]) -> DataFrame:
    """(i, q) for every value of every column."""
    values = [F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in columns]
    if len(values) == 1:
        long = df.select(F.lit(0).alias("i"), values[0].alias("q"))
    else:
        long = df.select(F.posexplode(F.array(*values)).alias("i", "q"))
    return long.where(F.col("q").isNotNull())


def _order_statistics(df, columns, probs, wanted, pick_limit, more=None) -> tuple[dict[str, tuple[int, list]], dict[str, dict]]:
    """``{name: (count, values)}`` at ``wanted(name, count)``: ranks, each with where to look first.

    ``more``: {name: aggregate of the values}, worked out in the first job; given as ``{column: {name: value}}``.
    """
    names, more = list(columns), more or {}
    if not columns:
        return {}, {}
    long = _long(df, list(columns.values()))
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-_MARGIN, _MARGIN)})
    first = {r["i"]: r for r in long.groupBy("i").agg(
        F.count("q").alias("n"), F.min("q").alias("lo"), F.max("q").alias("hi"),
        F.percentile_approx("q", edges, SKETCH_ACCURACY).alias("e"),
        *[f(F.col("q")).alias(f"more_{m}") for m, f in more.items()],
    ).collect()}

    def bracket(i: int, p: float) -> tuple[float, float]:
        """The sketch's values right outside ``p``."""
        below, above = bisect_right(edges, p - _MARGIN / 2) - 1, bisect_left(edges, p + _MARGIN / 2)
        r = first[i]
        return r["e"][below] if below >= 0 else r["lo"], r["e"][above] if above < len(edges) else r["hi"]

    known: dict[tuple[int, int], float] = {}
    todo: dict[tuple[int, int], tuple[float, float]] = {}
    for i, r in sorted(first.items()):
        for k, p in wanted(names[i], r["n"]):
            if k == 0:
                known[i, k] = r["lo"]
            elif k == r["n"] - 1:
                known[i, k] = r["hi"]
            else:
                todo.setdefault((i, k), bracket(i, p))
    limits = {i: (r["lo"], r["hi"]) for i, r in first.items()}
    while todo:
        _step(long, len(columns), todo, known, limits, pick_limit)
    values = {
        name: (first[i]["n"], [known[i, k] for k, _ in wanted(name, first[i]["n"])])
        if i in first else (0, [])
        for i, name in enumerate(names)
    }
    return values, {name: {m: first[i][f"more_{m}"] if i in first else None for m in more} for i, name in enumerate(names)}


def _looked_up(values: list[float] | list[int], kind: str, at: Column) -> Column:
    """The value at a place of a list, which is one literal however long it is."""
    return F.get(F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>"), at)


def _any(tests: list[Column]) -> Column:
    """Whether one test holds; a tree of low depth, as each level of a plan takes the driver's stack."""
    half = len(tests) // 2
    return tests[0] if half == 0 else _any(tests[:half]) | _any(tests[half:])


def _table(brackets: list[list[_Bracket]], value) -> list[Column]:
    """Per slot: the bracket's value as a function of the column number."""
    slots = max(len(b) for b in brackets)
    out = []
    for s in range(slots):
        by_column = [float(value(b[s])) if s < len(b) else 0.0 for b in brackets]
        out.append(_looked_up(by_column, "double", F.col("i")))
    return out


def _step(long: DataFrame, n_columns: int, todo: dict, known: dict, limits: dict,
          pick_limit: int) -> None:
    """One round over all open ranks: each becomes known or gets a better bracket."""
    brackets = _brackets(todo, n_columns)
    lo, hi = _table(brackets, lambda b: b.lo), _table(brackets, lambda b: b.hi)
    q = F.col("q")
    counted = {r["i"]: r for r in long.groupBy("i").agg(*[
        F.count_if(test).alias(f"{name}{s}")
        for s in range(len(lo))
        for name, test in (("below", q < lo[s]), ("at_lo", q == lo[s]),
                           ("inside", (q > lo[s]) & (q < hi[s])),
                           ("at_hi", (q == hi[s]) & (hi[s] > lo[s])))
    ]).collect()}

    inner: dict[tuple[int, int], tuple[int, int, int]] = {}
    full: set[tuple[int, int]] = set()
    for per_column in brackets:
        for s, b in enumerate(per_column):
            below, at_lo, inside, at_hi = (
                counted[b.i][f"{w}{s}"] for w in ("below", "at_lo", "inside", "at_hi"))
            for k in b.ranks:
                at = k - below - at_lo
                if k < below:
                    todo[b.i, k] = (limits[b.i][0], b.hi)
                elif at < 0:
                    known[b.i, k] = b.lo
                elif at < inside:
                    inner[b.i, k] = (s, at, inside)
                    if inside > pick_limit:
                        full.add((b.i, s))
                elif at < inside + at_hi:
                    known[b.i, k] = b.hi
                else:
                    todo[b.i, k] = (b.lo, limits[b.i][1])
    tests = [(q > lo[s]) & (q < hi[s]) for s in range(len(lo))]
    within = long.where(_any(tests)).select("i", "q", F.explode(
        F.array_compact(F.array(*[F.when(t, F.lit(s)) for s, t in enumerate(tests)]))).alias("s"))
    _pick(within, {k: v for k, v in inner.items() if (k[0], v[0]) not in full}, known)
    _narrow(within, {k: v for k, v in inner.items() if (k[0], v[0]) in full}, todo)
    for key in [k for k in todo if k in known]:
        del todo[key]


def _brackets(todo: dict, n_columns: int) -> list[list[_Bracket]]:
    found: dict[tuple, _Bracket] = {}
    for (i, k), (lo, hi) in todo.items():
        found.setdefault((i, lo, hi), _Bracket(i, lo, hi)).ranks.append(k)
    out: list[list[_Bracket]] = [[] for _ in range(n_columns)]
    for b in found.values():
        out[b.i].append(b)
    return out


def _slot(keys) -> tuple[Column, int]:
    """One number per (column, slot), and how many there are up to the last of ``keys``."""
    slots = 1 + max(s for _, s in keys)
    return F.col("i") * slots + F.col("s"), slots


def _only(within: DataFrame, keys) -> DataFrame:
    """The rows of the given (column, slot) pairs."""
    at, slots = _slot(keys)
    wanted = {i * slots + s for i, s in keys}
    flags = [int(n in wanted) for n in range(max(wanted) + 1)]
    return within.where((F.col("s") < slots) & (_looked_up(flags, "int", at) == 1))


def _pick(within: DataFrame, inner: dict, known: dict) -> None:
    """Read the ranks off the value counts of their brackets, each of bounded size."""
    if not inner:
        return
    wanted = defaultdict(list)
    for (i, k), (s, at, _) in inner.items():
        wanted[i, s].append((at, k))
    counts = _only(within, wanted).groupBy("i", "s", "q").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("i", "s").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.select("i", "s", "q", "n", F.sum("n").over(run).alias("upto"))
    # The ranks of all brackets are looked up: a term for each would make a plan as deep as columns times ranks.
    slot, slots = _slot(wanted)
    by_slot = {i * slots + s: sorted({at for at, _ in ranks}) for (i, s), ranks in wanted.items()}
    tests = []
    for t in range(max(map(len, by_slot.values()))):
        nth = [by_slot[n][t] if t < len(by_slot.get(n, ())) else -1 for n in range(max(by_slot) + 1)]
        at = _looked_up(nth, "long", slot)
        tests.append((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at))
    for r in summed.where(_any(tests)).collect():
        for at, k in wanted[r["i"], r["s"]]:
            if r["upto"] - r["n"] <= at < r["upto"]:
                known[r["i"], k] = r["q"]


def _narrow(within: DataFrame, inner: dict, todo: dict) -> None:
    """Cut full brackets at a sketch of their inside."""
    if not inner:
        return
    keys = {(i, s) for (i, _), (s, _, _) in inner.items()}
    cuts = {(r["i"], r["s"]): r["e"] for r in _only(within, keys).groupBy("i", "s").agg(
        F.percentile_approx("q", [g / _GRID for g in range(_GRID + 1)], SKETCH_ACCURACY).alias("e")
    ).collect()}
    for (i, k), (s, at, inside) in inner.items():
        p = at / inside * _GRID
        e = cuts[i, s]
        todo[i, k] = (e[max(0, math.floor(p) - 1)], e[min(_GRID, math.ceil(p) + 1)])
