"""Nested ensembles: one fit of many deep trees scored as if it had fewer or shallower ones.

The first k trees of a forest are a forest of k trees, a tree cut at depth d is the tree that a limit of d had grown, and
boosting adds one tree after another. So a fit with the largest settings holds every smaller one of the same other
settings. The nodes come from the model's own saved form; their number is bounded by the model's settings, not by
the rows. Rows are scored in tasks, all trees and cuts of a batch together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from threading import Lock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountrisk.session import new_path

#: The driver holds the nodes of one model at a time, however many are scored side by side.
ONE_AT_A_TIME = Lock()
#: Rows scored together: rows x trees numbers are held a few times.
STEP_ROWS = 2_000


def nested_params(classifier: Estimator) -> tuple[str, ...]:
    """Parameters of which a fit with the largest value holds the smaller ones: number of trees, then depth."""
    if isinstance(classifier, RandomForestClassifier):
        return "numTrees", "maxDepth"
    return ("maxIter",) if isinstance(classifier, GBTClassifier) else ()


@dataclass
class Nodes:
    """Nodes of all trees in flat arrays; leaves have no children (-1)."""

    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    value: np.ndarray
    label: np.ndarray
    votes: bool
    #: Row of ``left_sets`` of nodes that split on categories (else -1), and the categories that go left.
    category: np.ndarray
    left_sets: np.ndarray

    def ends(self, cut: int | None) -> np.ndarray:
        """Where a row's way through trees cut at that depth ends. As when fitting, sister leaves of one label join."""
        leaf = self.left < 0
        if cut is None or not self.votes:
            return leaf
        ends = leaf | (self.depth >= cut)
        for level in range(min(cut, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == level) & ~leaf)
            a, b = self.left[at], self.right[at]
            ends[at[ends[a] & ends[b] & (self.label[a] == self.label[b])]] = True
        return ends

    def probabilities(self, x: np.ndarray, parts: Sequence[tuple[int | None, int | None]]) -> np.ndarray:
        """(rows, parts): probability of class 1 by the first ``trees`` trees cut at ``depth``."""
        cuts = sorted({depth for _, depth in parts}, key=lambda d: -1 if d is None else d)
        ends = [self.ends(cut) for cut in cuts]
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        found = [at.copy() for _ in cuts]
        going = [np.ones(at.shape, bool) for _ in cuts]
        rows = np.arange(len(x))[:, None]
        while True:
            for end, place, on in zip(ends, found, going, strict=True):
                place[on] = at[on]
                on &= ~end[at]
            inner = self.left[at] >= 0
            if not any(on.any() for on in going):
                break
            value = x[rows, self.feature[at]]
            goes_left = value <= self.threshold[at]
            if len(self.left_sets):
                known = np.clip(value, 0, self.left_sets.shape[1] - 1).astype(np.int64)
                goes_left = np.where(self.category[at] >= 0, self.left_sets[self.category[at], known], goes_left)
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
        sums = {cut: np.cumsum(self.value[place] * self.weights, axis=1) for cut, place in zip(cuts, found, strict=True)}
        out = np.empty((len(x), len(parts)))
        for i, (trees, depth) in enumerate(parts):
            n = len(self.roots) if trees is None else min(trees, len(self.roots))
            total = sums[depth][:, n - 1]
            out[:, i] = total / n if self.votes else 1.0 / (1.0 + np.exp(-2.0 * total))
        return out


def nodes_of(spark: SparkSession, model) -> Nodes:
    """The nodes of a fitted forest or boosted model, from its saved form, or of a forest's folder."""
    path = model if isinstance(model, str) else new_path(spark, "ensemble")
    if path != model:
        model.write().save(path)
    votes = path == model or isinstance(model, RandomForestClassificationModel)
    node = "nodeData"
    saved = spark.read.parquet(f"{path}/data").select(
        "treeID",
        f"{node}.id",
        f"{node}.prediction",
        f"{node}.impurityStats",
        f"{node}.leftChild",
        f"{node}.rightChild",
        f"{node}.split.featureIndex",
        f"{node}.split.numCategories",
        f"{node}.split.leftCategoriesOrThreshold",
    )
    rows = saved.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])

    def numbers(name: str, missing: float = -1) -> np.ndarray:
        return rows.column(name).combine_chunks().fill_null(missing).to_numpy(zero_copy_only=False)

    def lists(name: str) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, sizes) of a column of lists, null lists as empty."""
        sizes = pc.list_value_length(rows.column(name)).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
        return pc.list_flatten(rows.column(name)).combine_chunks().to_numpy(zero_copy_only=False), sizes

    tree, local = numbers("treeID").astype(np.int64), numbers("id").astype(np.int64)
    roots = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    start = roots[tree]  # ids count from 0 in every tree, parents before children
    left, right = numbers("leftChild").astype(np.int64), numbers("rightChild").astype(np.int64)
    left, right = np.where(left >= 0, start + left, -1), np.where(right >= 0, start + right, -1)
    depth = np.zeros(len(local), np.int64)
    for i in np.flatnonzero(left >= 0):
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    # a split holds its threshold, or the categories that go left
    split, sizes = lists("leftCategoriesOrThreshold")
    owner = np.repeat(np.arange(len(local)), sizes)
    arity = np.where(left >= 0, numbers("numCategories"), -1).astype(np.int64)
    chosen = np.flatnonzero(arity >= 0)
    category = np.full(len(local), -1, np.int64)
    category[chosen] = np.arange(len(chosen))
    left_sets = np.zeros((len(chosen), int(arity[chosen].max(initial=0))), bool)
    listed = arity[owner] >= 0
    left_sets[category[owner[listed]], split[listed].astype(np.int64)] = True
    threshold = np.zeros(len(local))
    threshold[owner[~listed]] = split[~listed]
    prediction = numbers("prediction").astype(np.float64)
    if votes:
        stats = lists("impurityStats")[0].reshape(len(local), -1)
        value, weights = stats[:, 1] / stats.sum(axis=1), np.ones(len(roots))
    else:
        value, weights = prediction, np.array(list(model.treeWeights))
    feature = np.maximum(numbers("featureIndex").astype(np.int64), 0)
    return Nodes(roots, weights, feature, threshold, left, right, depth, value, prediction, votes, category, left_sets)


def nested_scores(
    model, df: DataFrame, parts: Sequence[tuple[int | None, int | None]], keep: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keep`` and (position in ``parts``, probability): a row per part, a part being (trees, depth), None for all.
    ``model`` as in :func:`nodes_of`."""
    with ONE_AT_A_TIME:
        nodes = df.sparkSession.sparkContext.broadcast(nodes_of(df.sparkSession, model))
    rows = df.select(*keep, vector_to_array(features).alias("__x"))
    schema = T.StructType([*rows.schema.fields[:-1]]).add("position", "integer").add("probability", "double")
    parts, names = list(parts), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                n = part.num_rows
                x = part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                p = nodes.value.probabilities(x, parts)
                again = pa.array(np.repeat(np.arange(n), len(parts)))
                kept = [part.column(i).take(again) for i in range(part.num_columns - 1)]
                position = pa.array(np.tile(np.arange(len(parts), dtype=np.int32), n))
                yield pa.RecordBatch.from_arrays([*kept, position, pa.array(p.reshape(-1))], names)

    return rows.mapInArrow(run, schema)
