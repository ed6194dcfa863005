"""Tree models as tables of rules, and scoring by joins with them.

A fitted tree, forest or boosted model is read from its saved form into one row per node. Rows are then routed from the
root, level by level: a table goes in, a table comes out. Up to a bounded number of nodes are sent to where the rows are; larger
models, which may have more nodes than a driver holds, are met in an equi-join per level. Either way routes any number of models at once, and says at every depth where a row stands. Since a
tree grows greedily, that is where the tree cut at this depth would have left it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.operators.joins import broadcast_if_small
from loamwork.workspace import fresh_path

NODES = ["tree", "node", "parent", "slot", "threshold", "categories", "left", "right", "prediction", "stats", "weight"]
#: Nodes of all trees together that are sent to every task, some 40 bytes each.
HELD_NODES = 1_000_000


def node_table(spark: SparkSession, model, tree: int | None = None) -> DataFrame:
    """One row per node of a fitted tree model.

    tree, node and parent number trees and nodes, the root is node 0 and has no parent. Inner nodes send a row to ``left`` if the
    feature ``slot`` is at most ``threshold``, or is one of ``categories``; leaves have none of these. ``prediction`` and ``stats``
    (class counts; or count, sum and sum of squares) are the node's own, ``weight`` is the tree's in an ensemble.
    ``tree`` numbers a single tree among others.
    """
    path = fresh_path(spark, "tree-model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "treeID" in saved.columns:
        # Its columns go by their place: number, settings and weight of each tree.
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "settings", "weight").drop("settings")
        saved = saved.join(F.broadcast(weights), "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")
    else:
        saved = saved.select(F.lit(tree or 0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    inner = F.col("leftChild") >= 0
    ordered = F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    nodes = saved.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").cast("int").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("slot"),
        F.when(inner & ordered, values[0]).alias("threshold"), F.when(inner & ~ordered, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", F.col("impurityStats").alias("stats"), "weight",
    )
    children = nodes.where("left IS NOT NULL").select("tree", F.col("node").alias("parent"), F.explode(F.array("left", "right")).alias("node"))
    return nodes.join(children, ["tree", "node"], "left").select(*NODES)


def depth_of(nodes: DataFrame) -> int:
    """Levels below the root of the deepest tree: one narrow join per level."""
    frontier, depth = nodes.where("parent IS NULL").select("tree", "node"), 0
    links = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node"), F.col("node").alias("child"))
    while True:
        frontier = frontier.join(links, ["tree", "node"]).select("tree", F.col("child").alias("node"))
        if frontier.isEmpty():
            return depth
        depth += 1


def _key(node: Column) -> Column:
    """Tree and node as one number, which joins look up faster than a pair."""
    return F.shiftleft(F.col("tree").cast("bigint"), 32) + node


class _Lookup:
    """Node tables as arrays, through which many rows descend at once."""

    def __init__(self, table: pa.Table):
        tree, node = (table.column(c).to_numpy().astype(np.int64) for c in ("tree", "node"))
        key = tree << 32 | node
        order = np.argsort(key)
        table, key, self.tree, self.node = table.take(order), key[order], tree[order].astype(np.int32), node[order].astype(np.int32)
        inner = table.column("left").is_valid().to_numpy()
        own = np.arange(len(key))

        def child(side: str) -> np.ndarray:
            found = self.tree.astype(np.int64) << 32 | table.column(side).fill_null(0).to_numpy()
            return np.where(inner, np.searchsorted(key, found), own).astype(np.int32)

        # Leaves lead to themselves.
        self.left, self.right = child("left"), child("right")
        self.slot = table.column("slot").fill_null(0).to_numpy().astype(np.int32)
        self.threshold = table.column("threshold").fill_null(float("nan")).to_numpy()
        self.value = table.column("prediction").to_numpy()
        self.roots = np.flatnonzero(table.column("parent").is_null().to_numpy())
        sets = [(i, s) for i, s in enumerate(table.column("categories").to_pylist()) if s is not None]
        #: Which of the sets a node has, and for each of them the categories that go left.
        self.set = np.full(len(key), -1, np.int32)
        self.among = np.zeros((len(sets), 1 + int(max((max(s, default=0) for _, s in sets), default=0))), bool)
        for k, (i, s) in enumerate(sets):
            self.set[i] = k
            self.among[k, np.array(s, np.int64)] = True

    def descend(self, values: np.ndarray, root: int, depth: int) -> Iterator[np.ndarray]:
        """The place of every row, at the root and after each level."""
        rows, at = np.arange(len(values)), np.full(len(values), root, np.int32)
        yield at
        for _ in range(depth):
            value = values[rows, self.slot[at]]
            goes_left = value <= self.threshold[at]
            if len(self.among):
                category = np.where(np.isfinite(value), value, -1).astype(np.int64)
                known = (self.set[at] >= 0) & (category == value) & (category >= 0) & (category < self.among.shape[1])
                goes_left |= known & self.among[self.set[at], np.where(known, category, 0)]
            at = np.where(goes_left, self.left[at], self.right[at])
            yield at


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Arrays of numbers as rows of one matrix; what is missing is no number."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy()
    flat, width = vectors.flatten().to_numpy(zero_copy_only=False), int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), np.nan)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def descended(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features", watch: Sequence[int] = ()) -> DataFrame:
    """``rows`` once per tree, with ``tree``, ``leaf``, the leaf's ``value`` and ``at``: a prediction per watched depth.

    ``depth`` levels are descended; rows that reach a leaf earlier stay there. Up to ``HELD_NODES`` nodes are looked up where the
    rows are, all levels in one step. More of them are met level by level, in joins.
    """
    if nodes.count() > HELD_NODES:
        return _joined(rows, nodes, depth, features, watch)
    table = nodes.select("tree", "node", "parent", "slot", "threshold", "categories", "left", "right", "prediction").toArrow()
    model = rows.sparkSession.sparkContext.broadcast(_Lookup(table))
    watched = list(watch)

    @F.arrow_udf("array<struct<tree: int, leaf: int, value: double, at: array<double>>>")
    def places(vectors: pa.Array) -> pa.Array:
        lookup, values = model.value, _matrix(vectors)
        trees, n = len(lookup.roots), len(vectors)
        ends, seen = np.empty((n, trees), np.int32), np.empty((n, trees, len(watched)))
        for k, root in enumerate(lookup.roots):
            for level, at in enumerate(lookup.descend(values, root, depth)):
                if level in watched:
                    seen[:, k, watched.index(level)] = lookup.value[at]
            ends[:, k] = at
            # Depths below the deepest leaf see the leaf.
            for i, level in enumerate(watched):
                if level > depth:
                    seen[:, k, i] = lookup.value[at]
        flat = ends.ravel()
        at = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(watched)), pa.array(seen.ravel()))
        found = pa.StructArray.from_arrays(
            [pa.array(lookup.tree[flat]), pa.array(lookup.node[flat]), pa.array(lookup.value[flat]), at], names=["tree", "leaf", "value", "at"]
        )
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), found)

    found = rows.withColumn("_place", F.explode(places(vector_to_array(features))))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], "_place.tree", "_place.leaf", "_place.value", "_place.at")


def _joined(rows: DataFrame, nodes: DataFrame, depth: int, features: str, watch: Sequence[int]) -> DataFrame:
    """:func:`descended` by one join with the inner nodes per level.

    A node tells its children's predictions, so what a row carries is the node it has reached and that node's prediction.
    """
    below = nodes.select("tree", "node", "prediction")
    left = below.select("tree", F.col("node").alias("left"), F.col("prediction").alias("_left_value"))
    right = below.select("tree", F.col("node").alias("right"), F.col("prediction").alias("_right_value"))
    steps = broadcast_if_small(nodes.where("left IS NOT NULL").join(left, ["tree", "left"]).join(right, ["tree", "right"]).select(
        _key(F.col("node")).alias("_at"), F.col("slot").alias("_slot"), F.col("threshold").alias("_threshold"), F.col("categories").alias("_categories"),
        _key(F.col("left")).alias("_left"), _key(F.col("right")).alias("_right"), "_left_value", "_right_value",
    ))
    roots = [F.struct(F.lit(r["tree"]).alias("tree"), F.lit(r["prediction"]).alias("value")) for r in nodes.where("parent IS NULL").select("tree", "prediction").orderBy("tree").collect()]
    started = rows.withColumns({"_values": vector_to_array(features), "_root": F.explode(F.array(*roots))})
    current = started.withColumns({"tree": F.col("_root.tree"), "_value": F.col("_root.value")}).drop("_root").withColumn("_at", _key(F.lit(0)))
    seen: dict[int, Column] = {}
    for level in range(depth + 1):
        if level in watch:
            current = current.withColumn(f"_seen_{level}", F.col("_value"))
            seen[level] = F.col(f"_seen_{level}")
        if level < depth:
            value = F.get("_values", F.col("_slot"))
            goes_left = F.when(F.col("_categories").isNull(), value <= F.col("_threshold")).otherwise(F.array_contains("_categories", value))
            # Leaves are not among the steps: their rows stay.
            current = current.join(steps, "_at", "left").withColumn("_goes", F.when(F.col("_left").isNotNull(), F.coalesce(goes_left, F.lit(False))))
            current = current.withColumns({
                "_at": F.when(F.col("_goes"), F.col("_left")).when(~F.col("_goes"), F.col("_right")).otherwise(F.col("_at")),
                "_value": F.when(F.col("_goes"), F.col("_left_value")).when(~F.col("_goes"), F.col("_right_value")).otherwise(F.col("_value")),
            }).drop("_slot", "_threshold", "_categories", "_left", "_right", "_left_value", "_right_value", "_goes")
    # Depths below the deepest leaf see the leaf.
    at = F.array(*[seen.get(level, F.col("_value")) for level in watch]) if watch else F.array().cast("array<double>")
    return current.select(
        *[F.col(f"`{c}`") for c in rows.columns], "tree", F.col("_at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("leaf"), F.col("_value").alias("value"), at.alias("at"),
    )


def routed(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features", watch: Sequence[int] = ()) -> DataFrame:
    """``rows`` as :func:`descended`, with the leaf's ``stats`` and ``weight`` too."""
    facts = broadcast_if_small(nodes.select("tree", F.col("node").alias("leaf"), "stats", "weight"))
    found = descended(rows, nodes, depth, features, watch).join(facts, ["tree", "leaf"])
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], "tree", "leaf", "value", "stats", "weight", "at")


def _summed(arrays: Column) -> Column:
    """Slot by slot sum of an array of arrays of one length."""
    return F.aggregate(F.slice(arrays, 2, F.greatest(F.size(arrays) - 1, F.lit(0))), arrays[0], lambda total, more: F.zip_with(total, more, lambda x, y: x + y))


def predicted(rows: DataFrame, nodes: DataFrame, depth: int, classes: bool, mean: bool = False, features: str = "features") -> DataFrame:
    """Every row with ``rule_prediction``: what the rules say of it.

    With ``classes`` the trees' class shares are added up and the first of the largest wins; else the weighted predictions are
    added up, over the weights if ``mean``. One tree's answer stands with its nodes; those of several trees meet in one
    shuffle, and those of a row before it, in the task that routed the row.
    """
    whole = F.aggregate("stats", F.lit(0.0), lambda s, x: s + x)
    first = lambda shares: (F.array_position(shares, F.array_max(shares)) - 1).cast("double")
    kept = [F.col(f"`{c}`") for c in rows.columns]
    if nodes.where("parent IS NULL").count() == 1:
        said = nodes.withColumn("shares", F.transform("stats", lambda x: x / whole)).withColumn("rule_prediction", first(F.col("shares"))) if classes else (
            nodes.withColumn("rule_prediction", (F.lit(0.0) + F.col("prediction") * F.col("weight")) / (F.col("weight") if mean else F.lit(1.0)))
        )
        facts = broadcast_if_small(said.select("tree", F.col("node").alias("leaf"), "rule_prediction"))
        return descended(rows, nodes, depth, features).join(facts, ["tree", "leaf"]).select(*kept, "rule_prediction")
    # The rows' numbers hold for this plan only, in which nothing else refers to them.
    found = routed(rows.withColumn("_row", F.monotonically_increasing_id()), nodes, depth, features)
    if classes:
        votes = F.struct("tree", F.transform("stats", lambda x: x / whole).alias("shares"))
        answer = F.transform("parts", lambda p: p["shares"])
    else:
        votes = F.struct("tree", "value", "weight")
        weights = F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["weight"]) if mean else F.lit(1.0)
    # Summed in the order of the trees, so that sums don't depend on the plan.
    parts = found.groupBy("_row").agg(*[F.first(c).alias(n) for c, n in zip(kept, rows.columns)], F.sort_array(F.collect_list(votes)).alias("parts"))
    if classes:
        return parts.withColumn("total", _summed(answer)).select(*kept, first(F.col("total")).alias("rule_prediction"))
    total = F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["value"] * p["weight"])
    return parts.select(*kept, (total / weights).alias("rule_prediction"))


def scored(rows: DataFrame, nodes: DataFrame, depth: int, key: Sequence[str], classes: bool, mean: bool = False, features: str = "features") -> DataFrame:
    """(key, rule_prediction): what the rules say of every key, as :func:`predicted`; rows of equal ``key`` must have equal features."""
    found = predicted(rows.select(*key, features), nodes, depth, classes, mean, features)
    return found.groupBy(*key).agg(F.max("rule_prediction").alias("rule_prediction"))


def recounted(rows: DataFrame, nodes: DataFrame, depth: int, label: str = "label", features: str = "features") -> DataFrame:
    """(tree, leaf, n, mean, model_n, model_mean): rows and mean label of each leaf, by routing and as the model has them.

    For leaves of regression trees, whose ``stats`` are count, sum and sum of squares.
    """
    found = routed(rows.select(label, features), nodes, depth, features)
    return found.groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), F.max(F.col("stats")[0]).cast("bigint").alias("model_n"), F.max(F.col("stats")[1] / F.col("stats")[0]).alias("model_mean")
    )


def class_counts(rows: DataFrame, nodes: DataFrame, depth: int, by: Sequence[str] = (), label: str = "label", features: str = "features") -> DataFrame:
    """(tree, leaf, by, class, n): rows of each class in each leaf, by routing, per group of ``by``."""
    found = descended(rows.select(*by, label, features), nodes, depth, features)
    return found.groupBy("tree", "leaf", *by, F.col(label).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def recounted_classes(rows: DataFrame, nodes: DataFrame, depth: int, label: str = "label", features: str = "features", counts: DataFrame | None = None) -> DataFrame:
    """(tree, leaf, class, n, model_n): rows of each class in each leaf, by routing and as the model has them.

    ``counts`` are the :func:`class_counts` of the rows, where the caller has them already.
    """
    found = class_counts(rows, nodes, depth, (), label, features) if counts is None else counts
    counted = found.groupBy("tree", "leaf", "class").agg(F.sum("n").alias("n"))
    leaves = nodes.where("left IS NULL").select("tree", F.col("node").alias("leaf"), F.posexplode("stats").alias("class", "model_n")).where("model_n > 0")
    return leaves.join(counted, ["tree", "leaf", "class"], "full").select("tree", "leaf", "class", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("model_n", F.lit(0.0)).cast("bigint").alias("model_n"))


def conditions(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, slot, above, up_to, categories): the path to each leaf, as the bounds it sets on each feature.

    A feature's value must be greater than ``above``, at most ``up_to`` and one of ``categories``; null where there is no bound.
    Paths are climbed from all leaves at once, a join per level.
    """
    up = nodes.where("left IS NOT NULL").select("tree", F.col("node").alias("parent"), "slot", "threshold", F.col("categories").alias("left_categories"), "left")
    climbing = nodes.where("left IS NULL").select("tree", F.col("node").alias("leaf"), "node", "parent")
    links = nodes.select("tree", F.col("node").alias("parent"), F.col("parent").alias("above_parent"))
    steps = []
    while not climbing.where("parent IS NOT NULL").isEmpty():
        step = climbing.join(up, ["tree", "parent"]).withColumn("is_left", F.col("left") == F.col("node"))
        steps.append(step.select(
            "tree", "leaf", "slot", F.when(~F.col("is_left"), F.col("threshold")).alias("above"), F.when(F.col("is_left"), F.col("threshold")).alias("up_to"),
            F.when(F.col("is_left"), F.col("left_categories")).alias("among"), F.when(~F.col("is_left"), F.col("left_categories")).alias("outside"),
        ))
        climbing = climbing.where("parent IS NOT NULL").join(links, ["tree", "parent"]).select("tree", "leaf", F.col("parent").alias("node"), F.col("above_parent").alias("parent"))
    if not steps:
        return nodes.where("false").select("tree", F.col("node").alias("leaf"), "slot", F.col("threshold").alias("above"), F.col("threshold").alias("up_to"), F.col("categories").alias("among"), F.col("categories").alias("outside"))
    def both(sets):
        return F.when(F.size(sets) > 0, F.aggregate(F.slice(sets, 2, F.greatest(F.size(sets) - 1, F.lit(0))), sets[0], lambda kept, more: F.array_intersect(kept, more)))

    return reduce(DataFrame.unionByName, steps).groupBy("tree", "leaf", "slot").agg(
        F.max("above").alias("above"), F.min("up_to").alias("up_to"), both(F.collect_list("among")).alias("among"),
        F.when(F.count("outside") > 0, F.array_sort(F.array_distinct(F.flatten(F.collect_list("outside"))))).alias("outside"),
    )
