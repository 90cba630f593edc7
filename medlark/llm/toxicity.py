"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.types import col
from medlark.llm.common import Words, keyed_order, slices

#: At most about so many labelled rows fit the voters, the label model and the classifier.
MOST_LABELLED = 20_000
#: Words and word starts that the classifier looks at.
FEATURES = 600
#: Log ratio of an entry's share of toxic to that of clean documents.
LEAST_RATIO = 1.0
#: Lexicon entries that are dealt to the lexicon voters, of either kind.
LEXICON = 240
WORD_VOTERS = 24
START_VOTERS = 12
#: Documents of one label that must hold an entry.
LEAST_DOCUMENTS = 3
#: How often a given label is taken to be right.
ANNOTATOR = 0.97
STARTS = (5, 7)
STYLES = ("shouting", "exclaiming", "symbols")
MOST_BROADCAST = 2_000_000
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _entries(word: bytes) -> list[str]:
    """What a word counts as: itself, lower-cased and without marks at its edges, and its starts."""
    w = word.decode("utf-8", "replace").lower().strip(_EDGES)
    if not w:
        return []
    return [w, *[w[:k] + "*" for k in STARTS if len(w) > k]]


def _distinct_pairs(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    most = int(item.max()) + 1 if len(item) else 1
    both = np.unique(doc.astype(np.int64) * most + item)
    return both // most, both % most


def _style_hits(text: str | None) -> list[int]:
    """Which of the style patterns a text shows."""
    t = text or ""
    letters = sum(map(str.isalpha, t)) or 1
    words = max(1, t.count(" "))
    return [int(sum(map(str.isupper, t)) > 0.3 * letters), int(t.count("!") > 0.05 * words),
            int(sum(t.count(c) for c in "#*$%&") > 0.1 * words)]


def _document_counts(rows: DataFrame) -> DataFrame:
    """entry, toxic, clean: documents of either label that hold the entry."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(0)):
                words = Words(b.column(0).slice(lo, hi - lo))
                label = b.column(1).slice(lo, hi - lo).to_numpy()
                names: dict[str, int] = {}
                held = [[names.setdefault(e, len(names)) for e in _entries(w)] for w in words.vocabulary]
                doc, word = _distinct_pairs(words.texts(), words.ids)
                n = np.fromiter(map(len, held), np.int64, len(held))
                flat = np.fromiter((e for h in held for e in h), np.int64, int(n.sum()))
                first = np.cumsum(n) - n
                at = np.repeat(first[word] - (np.cumsum(n[word]) - n[word]), n[word]) + np.arange(n[word].sum())
                d, e = _distinct_pairs(np.repeat(doc, n[word]), flat[at])
                toxic = np.bincount(e, weights=label[d] == 1, minlength=len(names)).astype(np.int64)
                every = np.bincount(e, minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(names), pa.string()), pa.array(toxic), pa.array(every - toxic)],
                    names=["entry", "toxic", "clean"])

    parts = rows.mapInArrow(count, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _hits(texts: pa.Array, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, entry) pairs, each once."""
    words = Words(texts)
    held = [[index[e] for e in _entries(w) if e in index] for w in words.vocabulary]
    n = np.fromiter(map(len, held), np.int64, len(held))
    used = n[words.ids] > 0
    doc, word = _distinct_pairs(words.texts()[used], words.ids[used])
    flat = np.fromiter((e for h in held for e in h), np.int64, int(n.sum()))
    first = np.cumsum(n) - n
    k = n[word]
    at = np.repeat(first[word] - (np.cumsum(k) - k), k) + np.arange(k.sum())
    return _distinct_pairs(np.repeat(doc, k), flat[at])


def _votes(hits: list[list[int]], style: list[list[int]], entries: list[str], lexicon: int) -> np.ndarray:
    """Rows x voters of 1 (toxic), -1 (clean) and 0 (no vote).

    The first ``lexicon`` entries, best first, are dealt in turn to lexicon voters (words) and
    pattern voters (word starts); two voters per kind count distinct entries; the rest are styles.
    """
    start = np.array([e.endswith("*") for e in entries[:lexicon]], bool)
    voter = np.where(start, WORD_VOTERS + (np.cumsum(start) - 1) % START_VOTERS,
                     (np.cumsum(~start) - 1) % WORD_VOTERS)
    dealt = WORD_VOTERS + START_VOTERS
    out = np.zeros((len(hits), dealt + 2 + len(STYLES)), np.int8)
    for i, row in enumerate(hits):
        own = [e for e in row if e < lexicon]
        out[i, voter[own]] = 1
        for j, kind in enumerate((False, True)):
            n = sum(start[e] == kind for e in own)
            out[i, dealt + j] = 1 if n > 1 else -1 if n == 0 else 0
        out[i, dealt + 2:] = style[i]
    return out


@dataclass
class LabelModel:
    """P(vote | label) for each voter, the discount of correlated voters, and the prior."""

    prior: float
    table: np.ndarray  # label x voter x vote (-1, 0, 1)
    discount: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        v = votes.astype(np.int64) + 1
        j = np.arange(votes.shape[1])
        odds = ((np.log(self.table[1][j, v]) - np.log(self.table[0][j, v])) * self.discount).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds + np.log(self.prior / (1 - self.prior)), -30, 30)))


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 25) -> LabelModel:
    """Accuracies and correlations of the voters by expectation maximisation.

    Each round takes the posterior as labels: it counts votes per label, and measures how far the
    voters' errors go together once the label is known. A voter's evidence is divided by one plus
    its positive correlations, so copies of one voter count once. The last voter is the given
    label; it is taken to be right in ANNOTATOR of the cases, so that the others can outvote it.
    """
    m = votes.shape[1]
    trusted = np.array([[ANNOTATOR, 1e-9, 1 - ANNOTATOR], [1 - ANNOTATOR, 1e-9, ANNOTATOR]])
    table = np.empty((2, m, 3))
    table[1] = [0.2, 0.4, 0.4]
    table[0] = [0.4, 0.4, 0.2]
    table[:, -1] = trusted
    seen = np.stack([votes == k for k in (-1, 0, 1)], 2).astype(float)
    model = LabelModel(min(max(prior, 0.01), 0.99), table, np.ones(m))
    # At the start a voter says little, so no few of them decide; their number is what counts.
    model.discount[:-1] = 0.5
    for _ in range(rounds):
        p = model.posterior(votes)
        for y, w in ((1, p), (0, 1 - p)):
            model.table[y] = (np.einsum("i,ijk->jk", w, seen) + 0.5) / (w.sum() + 1.5)
        model.table[:, -1] = trusted
        expected = (p[:, None] * (model.table[1][:, 2] - model.table[1][:, 0])
                    + (1 - p)[:, None] * (model.table[0][:, 2] - model.table[0][:, 0]))
        rest = votes - expected
        spread = np.sqrt((rest ** 2).mean(0)) + 1e-6
        corr = (rest.T @ rest) / len(votes) / np.outer(spread, spread)
        np.fill_diagonal(corr, 0)
        corr[-1] = corr[:, -1] = 0
        model.discount = 1 / (1 + np.clip(corr, 0, 1).sum(1))
        model.prior = float(np.clip(p.mean(), 0.01, 0.99))
    return model


def fit_linear(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, features: int,
               steps: int = 400, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; (rows, columns) are the ones of a 0/1 matrix.

    Both labels weigh the same in sum, so that 0.5 is the line between them whatever their shares.
    """
    theta = np.zeros(features + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    share = min(max(target.mean(), 1e-3), 1 - 1e-3) if len(target) else 0.5
    balance = target / (2 * share) + (1 - target) / (2 * (1 - share))
    for t in range(1, steps + 1):
        z = np.bincount(rows, weights=theta[columns], minlength=len(target)) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * balance
        grad = np.append(np.bincount(columns, weights=error[rows], minlength=features), error.sum()) / max(1, len(target))
        grad[:-1] += penalty * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad ** 2
        theta -= 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, features: int = FEATURES,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """Score every document; labels of held-out ids (crc32 of the id mod 5 = 0) are never used.

    1. On at most about ``most_labelled`` labelled rows, drawn by a hash of the id, documents of
    either label are counted per word and word start. The entries that tell most become lexicons
    and patterns of many voters. 2. A generative model estimates the voters' accuracies and
    correlations; the given label is one voter of them. 3. A logistic regression on the entries is fitted to the
    model's posterior labels. 4. Every whole text is scored by the classifier.

    Returns doc_id, held_out, score, predicted. A null or empty text gets the score of a text without
    entries. Rows without a label, or with a null one, are scored like others; an id that comes
    twice among the labels counts once, as its highest label. With no usable label, or one label only, every score is 0. Null ids
    count as not held out. Other columns are ignored.
    """
    held = F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
    held = held & col(id_col).isNotNull()
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"), held.alias("held_out"))
    marks = labels.where(col(label_col).isNotNull() & col(id_col).isNotNull()).groupBy(
        col(id_col).alias("_id")).agg(F.max(col(label_col)).cast("int").alias("_label"))
    usable = marks.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
    n = usable.count()
    if n > most_labelled:
        usable = usable.where(keyed_order("toxic", F.col("_id")) < int(2 ** 60 * most_labelled / n))
    # At most about most_labelled rows of two numbers.
    usable = F.broadcast(usable) if most_labelled <= MOST_BROADCAST else usable
    sample = own.join(usable, F.col("doc_id") == F.col("_id")).select("text", "_label")
    n_toxic, n_all = sample.agg(F.sum("_label"), F.count(F.lit(1))).first()
    if not n_all or n_toxic in (0, n_all):
        return own.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    counts = _document_counts(sample)
    toxic = (F.col("toxic") + 0.5) / (n_toxic + 1)
    clean = (F.col("clean") + 0.5) / (n_all - n_toxic + 1)
    told = F.log(toxic / clean)
    # Words that lean to clean documents are of little use: there are as many as there are topics.
    ranked = F.desc(F.col("told") * F.sqrt("toxic"))
    chosen = counts.where(F.col("toxic") >= LEAST_DOCUMENTS).select("entry", "toxic", told.alias("told"))
    entries = [r["entry"] for r in chosen.where(F.col("told") > LEAST_RATIO).orderBy(ranked, "entry").limit(features).collect()]
    lexicon = min(LEXICON, len(entries))
    index = {e: i for i, e in enumerate(entries)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(0)):
                part = b.column(0).slice(lo, hi - lo)
                doc, entry = _hits(part, index)
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(entry, pa.int32())),
                    pa.array([_style_hits(t) for t in part.to_pylist()], pa.list_(pa.int32())),
                    b.column(1).slice(lo, hi - lo)], names=["hits", "style", "label"])

    seen = sample.mapInArrow(look, "hits array<int>, style array<int>, label int").collect()
    hits = [r["hits"] for r in seen]
    votes = np.column_stack([_votes(hits, [r["style"] for r in seen], entries, lexicon),
                             [1 if r["label"] else -1 for r in seen]])
    target = fit_label_model(votes, n_toxic / n_all).posterior(votes)
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    weights, bias = fit_linear(rows, np.array([e for h in hits for e in h], np.int64), target, len(entries))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                doc, entry = _hits(b.column(1).slice(lo, hi - lo), index)
                z = np.bincount(doc, weights=weights[entry], minlength=hi - lo) + bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(p),
                    pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(own.dtypes)["doc_id"]
    return own.select("doc_id", "text", "held_out").mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int")
