"""A quality classifier: gradient-boosted trees on histograms of document statistics.

Trees are grown on the driver from a bounded sample of labelled rows (`sample`: labels of least id hash, and of the texts with those
ids, which may be more, rows of least hash), on binned features, level by level, from sums of gradients per bin. The ensemble is flattened into five arrays (feature, threshold, left,
right, value) and applied to whole Arrow batches: all texts go down one level of one tree at once.

Nulls: a null text is empty and gets a score like any other; rows with a null label aren't learned from; a null id is not held
out and never learned from. Labels repeated for a document each count. With no labels every score is 0.5. Ties: of splits with equal gain the first feature's
lowest threshold counts; what is made of a score of 0.5 is the caller's matter (the query predicts 1). Repeated rows get equal scores.
Empty tables of documents give no rows. A very long text is read whole, as one row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import text_slices
from recsieve.llm.textstats import NAMES, SCHEMA, stats_batches, text_stats

SAMPLE = 20_000


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios from rows of text_stats."""
    c = {name: stats[:, i].astype(float) for i, name in enumerate(NAMES)}
    n, lines, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["n_letters"], 1)
    chars = np.maximum(c["word_chars"], 1)
    parts = [np.log1p(c["n_words"]), c["word_chars"] / n, c["n_symbols"] / n, c["n_dup_lines"] / lines, c["n_repeat_words"] / n, c["n_ended_lines"] / lines, c["n_upper"] / letters, c["n_letters"] / chars, c["n_digits"] / chars, c["n_marks"] / n, c["n_unique_words"] / n, c["n_long_words"] / n, n / lines]
    return np.stack(parts, axis=1)


@dataclass
class Trees:
    """Flattened trees: node i of tree t is at roots[t] + i. A leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: int = 10) -> Trees:
    """Boosting for the logistic loss. Splits are the best gain over bin edges, the edges being quantiles of each feature."""
    if not len(y) or y.min() == y.max():
        rate_of_one = float(y.mean()) if len(y) else 0.5
        p = min(max(rate_of_one, 0.01), 0.99)
        leaf = np.zeros(1, dtype=np.int64)
        return Trees(np.zeros(0, dtype=np.int64), leaf, np.zeros(1), leaf, leaf, np.zeros(1), depth, math.log(p / (1 - p)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = math.log(y.mean() / (1 - y.mean()))
    total = np.full(len(y), base)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        root = len(feature)
        roots.append(root)
        open_nodes = {root: np.arange(len(y))}
        for a in (feature, left, right):
            a.append(root if a is not feature else 0)
        threshold.append(0.0)
        value.append(0.0)
        for level in range(depth + 1):
            following: dict[int, np.ndarray] = {}
            for node, rows in open_nodes.items():
                gs, hs = g[rows].sum(), h[rows].sum()
                best, where = 1e-6, None
                if level < depth and len(rows) >= 2 * least:
                    for f, e in enumerate(edges):
                        if not len(e):
                            continue
                        b = binned[rows, f]
                        gl, hl, nl = (np.cumsum(np.bincount(b, weights=w, minlength=len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                        gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                        gain[(nl < least) | (len(rows) - nl < least)] = -1
                        k = int(np.argmax(gain))
                        if gain[k] > best:
                            best, where = gain[k], (f, k)
                if where is None:
                    value[node] = -rate * gs / (hs + l2)
                    left[node] = right[node] = node
                    total[rows] += value[node]
                    continue
                f, k = where
                feature[node], threshold[node] = f, float(edges[f][k])
                low = binned[rows, f] <= k
                for side, part in ((left, rows[low]), (right, rows[~low])):
                    new = len(feature)
                    side[node] = new
                    for a in (feature, threshold, value):
                        a.append(0 if a is feature else 0.0)
                    left.append(new)
                    right.append(new)
                    following[new] = part
            open_nodes = following
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), depth, base)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id's text leaves 1 when divided by 3; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees from at most `sample` labelled rows that aren't held out, however many texts share an id."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    chosen = usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(stats_batches, f"id {kind}, label int, {SCHEMA}")
    rows = rows.orderBy(F.xxhash64("id", "label", *NAMES), "id", "label", *NAMES).limit(sample).toPandas()
    rows = rows.sort_values(["id", "label", *NAMES])
    return fit(features(rows[NAMES].to_numpy()), (rows["label"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col and score, the probability of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(trees.score(features(text_stats(data, offsets))))], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
