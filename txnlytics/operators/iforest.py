"""Isolation forest over (log amount, day of week, day of month).

Follows Liu, Ting and Zhou, "Isolation Forest" (2008). Trees grow in parallel from
small hash-drawn samples, one group per tree; scoring is row-local. Every random number
is taken from an MD5 digest of what it decides, so a forest depends on its rows and the
seed alone and SQL can repeat it. Standardising
the features is left out: axis splits drawn uniformly between a feature's extremes
give the same trees under any linear rescaling.
"""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from txnlytics.functions.labels import fixed, forest_severity, rupees
from txnlytics.operators.anomaly import txn_features
from txnlytics.params import Params
from txnlytics.session import materialise

_P = Params()

FEATURES = ("amount_log", "day_of_week", "day_of_month")
_HASH_RANGE = 1 << 32
_SCORE_DIGITS = 6
_EULER = 0.5772156649015329

#: Node 1 is the root, 2 n and 2 n + 1 are the children of n; a leaf has feature -1.
NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double"


def expected_path(rows: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree over ``rows`` rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + _EULER) - 2.0 * (rows - 1.0) / rows


def features(df: DataFrame) -> DataFrame:
    """Id, date, amount and the three features, nulls as zero."""
    return txn_features(df.select("txn_id", "date", "amount")).select(
        "txn_id",
        "date",
        "amount",
        *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES),
    )


def _digest(*salt) -> Column:
    """Digest of the salt and the transaction id."""
    parts = [s if isinstance(s, Column) else F.lit(str(s)) for s in salt]
    return F.md5(F.concat_ws(":", *parts, F.coalesce(F.col("txn_id").cast("string"), F.lit(""))))


def _draw(*salt) -> Column:
    """Number in [0, 2^32) fixed by the transaction id and the salt."""
    return F.conv(F.substring(_digest(*salt), 1, 8), 16, 10).cast("bigint")


def sample_rows(points: DataFrame, rows: int, p: Params) -> DataFrame:
    """About twice the wanted rows of every tree, drawn by hash of the id.

    One rule for every size: a row enters the pool with probability wanted / rows, and a
    row of the pool joins each tree with probability 2 * tree_rows / pool, both at most 1.
    The draw is a filter, hence no shuffle of the facts. Repeated ids count once, with the
    smallest features, so a hot id cannot swell a tree's group.
    """
    wanted = 2 * min(p.tree_rows, rows) * p.trees
    pooled = math.ceil(min(1.0, wanted / rows) * _HASH_RANGE)
    joined = math.ceil(min(1.0, 2 * p.tree_rows / min(rows, wanted)) * _HASH_RANGE)
    hits = F.filter(F.sequence(F.lit(0), F.lit(p.trees - 1)), lambda t: _draw(p.forest_seed, t.cast("string")) < joined)
    drawn = points.filter(_draw(f"pool {p.forest_seed}") < pooled).withColumn("tree", F.explode(hits))
    once = drawn.groupBy("txn_id", "tree").agg(F.min(F.struct(*FEATURES)).alias("x")).select("txn_id", "tree", "x.*")
    return once.withColumn("rank", _digest(f"rank {p.forest_seed}", F.col("tree").cast("string")))


def _uniform(seed: int, tree: int, node: int, what: str) -> float:
    """Number in [0, 1) with 52 bits."""
    return int(md5(f"{what} {seed}:{tree}:{node}".encode()).hexdigest()[:13], 16) / 16**13


def _grow(sample: np.ndarray, tree: int, seed: int) -> pd.DataFrame:
    """One tree as a node table; a leaf's ``path`` is its depth plus the unbuilt rest."""
    limit = math.ceil(math.log2(max(len(sample), 2)))
    nodes: list[tuple] = []
    pending = [(sample, 0, 1)]
    while pending:
        rows, depth, node = pending.pop()
        path = depth + expected_path(len(rows))
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(varying):
            nodes.append((tree, node, -1, 0.0, path))
            continue
        feature = int(varying[int(_uniform(seed, tree, node, "feature") * len(varying))])
        threshold = float(low[feature] + _uniform(seed, tree, node, "split") * (high[feature] - low[feature]))
        nodes.append((tree, node, feature, threshold, path))
        left = rows[:, feature] <= threshold
        pending += [(rows[left], depth + 1, 2 * node), (rows[~left], depth + 1, 2 * node + 1)]
    columns = [field.split()[0] for field in NODE_SCHEMA.split(", ")]
    return pd.DataFrame(nodes, columns=columns)


def build_forest(points: DataFrame, rows: int, p: Params = _P) -> DataFrame:
    """All trees as node rows: at most trees x (2 x tree_rows - 1) of them."""
    size, seed = min(p.tree_rows, rows), p.forest_seed

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        # Sorted by hash rank and id: the tree does not depend on partitioning.
        kept = pdf.sort_values(["rank", "txn_id"]).head(size)
        tree = int(pdf["tree"].iloc[0])
        return _grow(kept[list(FEATURES)].to_numpy(), tree, seed)

    return sample_rows(points, rows, p).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score_forest(points: DataFrame, forest: DataFrame, rows: int, p: Params = _P) -> DataFrame:
    """``score`` = -2^(-mean path / expected path) on every row; lower is odder.

    The node table is collected: its size is fixed by the parameters, not by the
    data. Scores keep six digits, which bounds the number of distinct values and
    makes the exact percentile cheap.
    """
    table = forest.toPandas()  # at most trees * (2 * tree_rows - 1) rows
    trees = []
    for _, nodes in table.sort_values(["tree", "node"]).groupby("tree"):
        # Rows of the node table by node number; a node without a row is never reached.
        row = np.zeros(2 * int(nodes["node"].max()) + 2, dtype=np.int64)
        row[nodes["node"]] = np.arange(len(nodes))
        below = [row[2 * nodes["node"].to_numpy() + side] for side in (0, 1)]
        trees.append((*(nodes[c].to_numpy() for c in ("feature", "threshold")), *below, nodes["path"].to_numpy()))
    shared = points.sparkSession.sparkContext.broadcast(trees)
    scale = expected_path(min(p.tree_rows, rows))

    @F.pandas_udf(T.DoubleType())
    def mean_path(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        x = np.column_stack([a, b, c])
        total = np.zeros(len(x))
        for feature, threshold, left, right, path in shared.value:
            at = np.zeros(len(x), dtype=np.int64)
            active = np.flatnonzero(feature[at] >= 0)
            while len(active):
                node = at[active]
                goes_left = x[active, feature[node]] <= threshold[node]
                at[active] = np.where(goes_left, left[node], right[node])
                active = active[feature[at[active]] >= 0]
            total += path[at]
        return pd.Series(total / len(shared.value))

    score = -F.pow(F.lit(2.0), -mean_path(*FEATURES) / F.lit(scale))
    return points.withColumn("score", F.round(score, _SCORE_DIGITS))


def contamination_offset(scores: DataFrame, p: Params = _P) -> float:
    """Exact, interpolated percentile of the scores, taken from their histogram."""
    histogram = scores.groupBy("score").agg(F.count("*").alias("n"))
    return histogram.agg(F.percentile("score", F.lit(p.contamination), F.col("n"))).first()[0]


def forest_scores(df: DataFrame, p: Params = _P, rows: int | None = None) -> DataFrame | None:
    """(txn_id, date, amount, decision) for every row; None below the minimum size.

    ``rows`` is the number of rows, where it is known already.
    """
    rows = df.count() if rows is None else rows
    if rows < p.forest_min_rows:
        return None
    points = features(df)
    forest = materialise(build_forest(points, rows, p), "forest")
    # Written once: the Python scoring pass feeds both the percentile and the result.
    scores = materialise(score_forest(points, forest, rows, p).drop(*FEATURES), "forest-scores")
    offset = contamination_offset(scores, p)
    return scores.withColumn("decision", F.col("score") - F.lit(offset)).drop("score")


def forest_outliers(df: DataFrame, p: Params = _P, rows: int | None = None) -> DataFrame:
    """Detections: rows whose decision score is below zero."""
    scores = forest_scores(df, p, rows)
    if scores is None:
        empty = df.limit(0).select("txn_id", "date", "amount")
        scores = empty.withColumn("decision", F.lit(0.0))
    decision = F.col("decision")
    reason = F.concat(
        F.lit("Isolation Forest detected unusual pattern. Transaction amount "), rupees(F.col("amount")),
        F.lit(" on "), F.date_format("date", "yyyy-MM-dd"),
        F.lit(" shows abnormal behaviour across multiple dimensions. Anomaly score: "),
        fixed(decision, 4), F.lit("."),
    )
    return scores.filter(decision < 0).select(
        "txn_id",
        F.lit("isolation_forest").alias("method"),
        forest_severity(decision, p).alias("severity"),
        reason.alias("reason"),
        F.lit(None).cast("double").alias("z_score"),
    )
