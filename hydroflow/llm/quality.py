"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once, in Arrow batches. The trees are fitted on labelled documents, on at
most ``max_rows`` of them, taken by the smallest hash of their id; that sample and the finished trees are all that
passes the driver. Growing a tree works on histograms: features are binned once, gradients are summed by node and bin,
and the split of a node comes from the running sums over its bins. Trees have full depth and are flattened into
three arrays (feature, threshold, leaf value), so scoring walks all documents of a batch down a tree at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import crc_remainder, text_or_empty, without_rows, word_blocks
from hydroflow.session import stored

FOLDS, HELD_OUT_FOLD = 5, 0
ACCEPT = 0.3
#: Labelled documents that the trees are fitted on, at most.
MAX_ROWS = 20_000

FEATURES = (
    "log_bytes log_words word_bytes upper digit other_punctuation sentence_marks loud_marks symbols bars blanks non_ascii "
    "control distinct_words top_word repeated_next odd_endings upper_words capital_words short_words log_lines "
    "repeated_lines words_per_line ended_lines entropy longest_word"
).split()

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_MARK = np.isin(_BYTES, [ord(c) for c in ".,;:"])
_LOUD = np.isin(_BYTES, [ord(c) for c in "!?"])
_BLANK = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#$%&*@^~|<>{}[]\\+=_"])
_OTHER = (_BYTES > 32) & (_BYTES < 127) & ~(_LETTER | _DIGIT | _MARK | _LOUD | _SYMBOL)
_CONTROL = ((_BYTES < 32) & ~_BLANK) | (_BYTES == 127)
_PLAIN_END = _LETTER | _DIGIT | _MARK | (_BYTES >= 128)
_PLAIN_ENDS = frozenset(np.flatnonzero(_PLAIN_END).tolist())


def statistics(text: str) -> list[float]:
    """The numbers that a score depends on; all of an empty text are zero."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    times: Counter = Counter()
    m, repeated, before = 0, 0, b""
    for words in word_blocks(raw):
        times.update(words)
        repeated += sum(a == b for a, b in zip([before, *words], words, strict=False))
        m, before = m + len(words), words[-1] if words else before
    if not m:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = seen / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, int(seen[_LETTER].sum()))
    used = share[share > 0]
    return [
        float(np.log1p(n)),
        float(np.log1p(m)),
        float(n - seen[_BLANK].sum()) / m,
        float(seen[_UPPER].sum()) / letters,
        *(float(share[group].sum()) for group in (_DIGIT, _OTHER, _MARK, _LOUD, _SYMBOL)),
        float(share[ord("|")]),
        *(float(share[group].sum()) for group in (_BLANK, _BYTES >= 128, _CONTROL)),
        len(times) / m,
        max(times.values()) / m,
        repeated / m,
        sum(c for w, c in times.items() if w[-1] not in _PLAIN_ENDS) / m,
        sum(c for w, c in times.items() if w.isupper()) / m,
        sum(c for w, c in times.items() if 65 <= w[0] <= 90) / m,
        sum(c for w, c in times.items() if len(w) <= 3) / m,
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines),
        m / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
        float(-(used * np.log2(used)).sum()),
        float(np.log1p(max(map(len, times)))),
    ]


@dataclass(frozen=True)
class Trees:
    """Full binary trees as arrays. Node i has children 2i+1 and 2i+2; the last level is the leaf values."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30))) if len(x) else np.empty(0)


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Up to ``bins - 1`` cut points per feature at its quantiles; a value at a cut point lies below it."""
    levels = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, levels, method="lower")) for column in x.T]


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    weight_penalty: float = 1.0,
    least_weight: float = 1.0,
) -> Trees:
    """Boosted trees for the log-odds of label 1. Without rows the score is a half, with one class near that class."""
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), dtype=np.int32)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, 2**depth))
    if not n or y.min() == y.max():
        return Trees(base, feature, threshold, leaf)
    edges = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    cuts = np.full((width, bins), np.inf)
    for f, e in enumerate(edges):
        cuts[f, : len(e)] = e
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = node - first
            gains = np.full((nodes, width, bins), -np.inf)
            for f in range(width):
                cell = place * bins + binned[:, f]
                g = np.bincount(cell, gradient, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                h = np.bincount(cell, weight, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                gr, hr = g[:, -1:] - g, h[:, -1:] - h
                allowed = (h >= least_weight) & (hr >= least_weight) & np.isfinite(cuts[f])
                gain = g**2 / (h + weight_penalty) + gr**2 / (hr + weight_penalty) - g[:, -1:] ** 2 / (h[:, -1:] + weight_penalty)
                gains[:, f][allowed] = gain[allowed]
            flat = gains.reshape(nodes, -1)
            best = flat.argmax(axis=1)
            split = flat[np.arange(nodes), best] > 1e-9
            feature[t, first : first + nodes] = np.where(split, best // bins, 0)
            threshold[t, first : first + nodes] = np.where(split, cuts[best // bins, best % bins], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        place = node - inner
        g, h = np.bincount(place, gradient, 2**depth), np.bincount(place, weight, 2**depth)
        leaf[t] = -rate * g / (h + weight_penalty)
        margin = margin + leaf[t][place]
    return Trees(base, feature, threshold, leaf)


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    body = text_or_empty(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(body).alias("k_hash"),
        F.octet_length(body).alias("k_len"),
        measure(body).alias("stats"),
    )


def _held_out(key: str = "doc_id"):
    return F.coalesce(crc_remainder(key, FOLDS) == HELD_OUT_FOLD, F.lit(False))


def fit_quality(measured: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees:
    """Trees from the labelled documents outside the held-out fold.

    Several labels of one document are averaged, a half counts as 1; NULL labels and labels without a document
    are left out, as are documents without an id.
    """
    marks = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("q"))
        .filter("label_id is not null and q is not null")
        .groupBy("label_id")
        .agg((F.avg("q") >= 0.5).cast("double").alias("label"))
        .filter(~_held_out("label_id"))
    )
    known = measured.join(marks, measured["doc_id"] == marks["label_id"]).select("doc_id", "k_hash", "stats", "label")
    # Only hashes that can be among the smallest are sent on to be sorted: a tenth more rows than asked for.
    n = known.count()
    if n > max_rows:
        last = min(int(1.1 * max_rows / n * 2**64), 2**64 - 1) - 2**63
        known = known.filter(F.xxhash64("doc_id") <= F.lit(last))
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id", "k_hash").limit(max_rows).select("stats", "label").collect()
    x = np.array([r["stats"] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r["label"] for r in rows], dtype=np.float64))


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, and its row key.

    Scores depend on the text alone. NULL texts count as empty; empty and blank texts get the score of a text
    whose statistics are all zero. Rows with a NULL id are scored, never learned from and not held out. Repeated
    rows each get a row. Other columns are not looked at. Without labels every score is a half.
    """
    measured = stored(_measured(docs, doc_id, text), "statistics")
    trees = fit_quality(measured, labels, max_rows)

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        x = np.array(stats.tolist(), dtype=np.float64).reshape(len(stats), len(FEATURES))
        return pd.Series(trees.scores(x))

    scored = measured.select("doc_id", "k_hash", "k_len", _held_out().alias("held_out"), score("stats").alias("score"))
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "k_hash", "k_len"
    )


def keep_accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the classifier accepts, columns unchanged; see ``score_quality``."""
    found = score_quality(docs, labels, doc_id, text).filter("predicted = 0")
    rejected = found.select(F.col("doc_id").alias("k_id"), "k_hash", "k_len").distinct()
    return without_rows(docs, stored(rejected, "rejected"), doc_id, text)
