"""Forests and boosted trees of many nodes, grown where the rows of a node meet.

Spark's own fit sends and searches the bins of all features for every open node, however few trips it holds:
deep forests have many nodes of a few trips. Here a node costs what its rows cost:

- Nodes of more than `TOGETHER` rows are split level by level. Tasks sum their rows by tree, node, feature and
  bin, and each node's sums (at most one row a bin) meet in a task that finds the split.
- Smaller nodes meet with all their rows, a node in one group, and are split to their leaves there.

Splits are those of Spark's trees: the largest fall of variance, categories in the order of their means, first
feature and first cut of equal ones, categories without rows to the right. Bags are Poisson draws by a hash of
the row, the tree and the seed, so a forest does not change with partitions; rows must differ, as cells do.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.cells import LABEL, WEIGHT

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no path to this package, as in all queries on trips
# Rows of a node that a task takes whole; rows (of all trees) in a partition of such nodes, about.
TOGETHER = 32_768
PARTITION = 500_000
# Rows up to which a boosted tree is grown in one task: jobs for its few large nodes would take longer. Rounds between two checkpoints.
ALONE, KEPT = 200_000, 5
# Different values of a number that the driver takes to find the thresholds of boosted trees.
VALUES = 200_000
# Falls of variance below this share of it, and variance below this share of the squared labels, are rounding.
GAIN, NOTHING = 1e-9, 1e-13
NODES = "tree INT, node BIGINT, weight DOUBLE, total DOUBLE, squares DOUBLE, rows BIGINT, feature INT, left ARRAY<DOUBLE>, gain DOUBLE"


def cuts(rows: DataFrame, arity: Sequence[int], bins: int) -> list[list[float]]:
    """The thresholds of each number (arity 0): the middles of its values, or at most `bins` - 1 quantiles of them."""
    found = []
    for f, categories in enumerate(arity):
        value = vector_to_array("features")[f].alias("value")
        seen = [] if categories else [r["value"] for r in rows.select(value).distinct().limit(bins + 1).collect()]
        if len(seen) > bins:
            shares = [k / bins for k in range(1, bins)]
            found.append(sorted(set(rows.select(F.percentile_approx(value, shares, 20 * bins)).first()[0])))
        else:
            seen.sort()
            found.append([(a + b) / 2 for a, b in zip(seen, seen[1:])])
    return found


def strides(rows: DataFrame, arity: Sequence[int], bins: int) -> list[list[float]]:
    """The thresholds of each number as Spark's fit takes them from all rows: the middles of its values, or of those next to
    equal shares of the weight. Numbers of more than `VALUES` values are cut by `cuts`."""
    found, rest = [], None
    for f, categories in enumerate(arity):
        value = vector_to_array("features")[f].alias("value")
        seen = None if categories else rows.groupBy(value).agg(F.sum(WEIGHT).alias("w")).limit(VALUES + 1).toArrow().sort_by("value")
        if categories:
            found.append([])
        elif seen.num_rows > VALUES:
            rest = rest or cuts(rows, arity, bins)
            found.append(rest[f])
        else:
            at, weight = seen["value"].to_numpy(), seen["w"].to_numpy()
            middle, reached = ((at[:-1] + at[1:]) / 2).tolist(), np.cumsum(weight).tolist()
            if len(middle) >= bins:
                stride = target = reached[-1] / bins
                kept = []
                for m, before, now in zip(middle, reached, reached[1:], strict=False):
                    if abs(before - target) < abs(now - target):
                        kept.append(m)
                        target += stride
                middle = kept
            found.append(middle)
    return found


def _drawn(of: Column, most: int = 16) -> Column:
    """How often a bag holds a row: Poisson with mean 1, from a hash."""
    u = F.pmod(of, F.lit(1 << 53)) / float(1 << 53)
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(most)])
    return sum((u >= F.lit(float(p))).cast("int") for p in below)


def _binned(rows: DataFrame, limits: list[list[float]], arity: Sequence[int]) -> DataFrame:
    """(bins, w, label, own): the bin of each feature, and a hash of the row. A checkpoint, as several jobs read it."""
    value = vector_to_array("features")
    own = F.xxhash64(value, LABEL, WEIGHT, "part").alias("own")

    def run(batches):
        for batch in batches:
            values = batch["value"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(arity)).T
            found = [v if n else np.searchsorted(at, v) for v, n, at in zip(values, arity, limits, strict=True)]
            flat = pa.array(np.array(found).astype(np.int32).T.ravel())
            bins = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * len(arity), flat)
            yield pa.RecordBatch.from_arrays([bins, batch[WEIGHT], batch[LABEL], batch["own"]], ["bins", "w", LABEL, "own"])

    typed = rows.select(value.alias("value"), F.col(WEIGHT).cast("double").alias(WEIGHT), F.col(LABEL).cast("double").alias(LABEL), own)
    return typed.mapInArrow(run, f"bins ARRAY<INT>, w DOUBLE, {LABEL} DOUBLE, own BIGINT").checkpoint()


def _bags(binned: DataFrame, trees: int, bootstrap: bool, seed: int) -> DataFrame:
    """(tree, node, bins, w, label, k): the rows in each tree's bag, at its root, k times."""
    each = binned.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    k = _drawn(F.xxhash64("own", "tree", F.lit(seed))) if bootstrap else F.lit(1)
    bagged = each.withColumn("k", k).filter("k > 0")
    return bagged.select("tree", F.lit(1).cast("long").alias("node"), "bins", (F.col("w") * F.col("k")).alias("w"), LABEL, "k")


def best(tables: list[tuple], weight: np.ndarray, total: np.ndarray, variance: np.ndarray, arity: Sequence[int], leaf: float):
    """The best split of every node: its feature (or -1), its gain, and for each feature the bins that occur as
    (node, bin, whether it goes left) with the place of every row among them.

    `tables` has (node, bin, weight, weighted label) of each feature, one row a trip, cell or sum; every node occurs.
    """
    feature, gain, found = np.full(len(weight), -1), GAIN * variance, []
    for f, (node, value, w, s) in enumerate(tables):
        span = int(value.max()) + 1
        key, back = np.unique(node * span + value, return_inverse=True)
        bw, bs = np.bincount(back, w), np.bincount(back, s)
        g, b = key // span, key % span
        order = np.lexsort((bs / bw, g)) if arity[f] else np.arange(len(key))
        first = np.searchsorted(g, np.arange(len(weight)))  # nodes stand in order either way
        lw, ls = (np.cumsum(x[order]) for x in (bw, bs))
        lw, ls = (x - (x[first] - y[order][first])[g] for x, y in ((lw, bw), (ls, bs)))
        rw, rs = weight[g] - lw, total[g] - ls
        ends = np.append(g[1:] != g[:-1], True)
        with np.errstate(divide="ignore", invalid="ignore"):
            got = (ls**2 / lw + rs**2 / rw - (total**2 / weight)[g]) / weight[g]
        got[ends | (lw < leaf - 1e-9) | (rw < leaf - 1e-9)] = -np.inf
        top = np.maximum.reduceat(got, first)
        at = np.flatnonzero(got == top[g])
        at = at[np.unique(g[at], return_index=True)[1]]
        left = np.empty(len(key), bool)
        left[order] = np.arange(len(key)) <= at[g]
        feature[top > gain] = f
        gain = np.maximum(gain, top)
        found.append((g, b, left, back))
    return feature, gain, found


def _lefts(feature: np.ndarray, found: list[tuple], limits: list[list[float]], arity: Sequence[int]) -> pa.Array:
    """What goes left in every node, as Spark's saved trees say it: categories, or a threshold."""
    nodes, values = [], []
    for f, (g, b, left, _) in enumerate(found):
        chosen = left & (feature[g] == f)
        g, b = g[chosen], b[chosen]
        if not arity[f]:
            last = np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool)
            g, b = g[last], np.asarray(limits[f])[b[last]] if len(g) else b
        nodes.append(g)
        values.append(b.astype(float))
    nodes, values = (np.concatenate(x) if x else np.zeros(0) for x in (nodes, values))
    sizes = np.bincount(nodes.astype(int), minlength=len(feature))
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, values[np.argsort(nodes, kind="stable")])


def _table(tree: int, ids, weight, total, squares, rows, feature, left, gain, center: float) -> pa.Table:
    """Rows of NODES, from sums over labels less `center`."""
    gain = np.where(feature < 0, -1.0, gain)
    whole, squared = total + center * weight, squares + 2 * center * total + center**2 * weight
    names = [c.split()[0] for c in NODES.split(", ")]
    columns = [np.full(len(ids), tree, np.int32), ids, weight, whole, squared, rows.astype(np.int64), feature.astype(np.int32)]
    return pa.table([*map(pa.array, columns), left, pa.array(gain)], names=names)


def _open(weight, total, squares, most: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The variance in nodes, and which may be split."""
    variance = squares / weight - (total / weight) ** 2
    return variance, (variance > NOTHING * most) & (weight >= least - 1e-6)


def _split(sums: pa.Table, limits, arity, leaf: float, least: float) -> pa.Table:
    """The split of one large node from its sums by feature and bin. All features sum to the same."""
    tree, node = sums["tree"][0].as_py(), sums["node"].to_numpy()[:1]
    feature, value, w, s, q, k = (sums[c].to_numpy() for c in ("feature", "value", "w", "s", "q", "k"))
    one = feature == 0
    center = s[one].sum() / w[one].sum()
    s, q = s - center * w, q - 2 * center * s + center**2 * w
    weight, total, squares, rows = (np.array([x[one].sum()]) for x in (w, s, q, k))
    chosen, gain, left = np.array([-1]), np.zeros(1), pa.array([[]], pa.list_(pa.float64()))
    variance, able = _open(weight, total, squares, (squares / weight)[0] + center**2, least)
    if able[0]:
        tables = [(np.zeros(np.sum(mine), np.int64), value[mine], w[mine], s[mine]) for mine in (feature == f for f in range(len(arity)))]
        chosen, gain, found = best(tables, weight, total, variance, arity, leaf)
        left = _lefts(chosen, found, limits, arity)
    return _table(tree, node, weight, total, squares, rows, chosen, left, gain, center)


def _subtree(rows: pa.Table, limits, arity, depth: int, leaf: float, least: float) -> pa.Table:
    """All nodes below one that is small enough, itself included, level by level."""
    tree, ids = rows["tree"][0].as_py(), rows["node"].to_numpy()[:1]
    bins = rows["bins"].combine_chunks().flatten().to_numpy().reshape(-1, len(arity)).T.astype(np.int64)
    w, y, k = (rows[c].to_numpy() for c in ("w", LABEL, "k"))
    order = np.lexsort((k, y, w, *bins))  # sums do not depend on how rows came
    bins, w, y, k = bins[:, order], w[order], y[order], k[order]
    center = np.average(y, weights=w)
    y, most, at, levels = y - center, float(np.max(y**2)), np.zeros(len(w), np.int64), []
    while len(ids):
        weight, total, squares, count = (np.bincount(at, x, len(ids)) for x in (w, w * y, w * y**2, k))
        variance, able = _open(weight, total, squares, most, least)
        able &= int(ids[0]).bit_length() - 1 < depth
        keep = able[at]
        place = np.cumsum(able) - 1
        bins, w, y, k, at = bins[:, keep], w[keep], y[keep], k[keep], place[at[keep]]
        feature, gain, found = np.full(len(ids), -1), np.zeros(len(ids)), []
        if len(w):
            chosen, got, found = best([(at, b, w, w * y) for b in bins], weight[able], total[able], variance[able], arity, leaf)
            feature[able], gain[able] = chosen, got
            nodes = np.flatnonzero(able)
            goes = np.zeros(len(w), bool)
            for f, (_, _, left, back) in enumerate(found):
                mine = chosen[at] == f
                goes[mine] = left[back[mine]]
            found = [(nodes[g], b, left, back) for g, b, left, back in found]
        levels.append(_table(tree, ids, weight, total, squares, count, feature, _lefts(feature, found, limits, arity), gain, center))
        split = feature >= 0
        if len(w):
            keep = chosen[at] >= 0
            child = 2 * (np.cumsum(chosen >= 0) - 1)[at[keep]] + ~goes[keep]
            bins, w, y, k, at = bins[:, keep], w[keep], y[keep], k[keep], child
        ids = (2 * ids[split][:, None] + np.array([0, 1])).ravel()
    return pa.concat_tables(levels)


def grown(
    rows: DataFrame, arity: Sequence[int], bins: int, trees: int, depth: int, leaf: float, least: float, bootstrap: bool, seed: int, together: int = TOGETHER
) -> DataFrame:
    """The nodes of a forest (`NODES`) on rows with `features`, label, weight and `part`, which are read several
    times. `node` is 1 at the root, the children of i are 2 i and 2 i + 1; `feature` is -1 in leaves. `arity` has the
    categories of each feature, 0 for a number; a child holds trips of weight `leaf`, a split node of `least`."""
    limits = cuts(rows, arity, bins)
    binned = _binned(rows, limits, arity)
    return _nodes(_bags(binned, trees, bootstrap, seed), binned.count(), trees, limits, arity, depth, leaf, least, together)


def _nodes(entries: DataFrame, size: int, trees: int, limits, arity: Sequence[int], depth: int, leaf: float, least: float, together: int) -> DataFrame:
    """The nodes of `trees` trees below the entries (tree, node, bins, w, label, k) of their roots, at most `size` of each tree."""
    spark, tops = entries.sparkSession, []
    for _ in range(depth if size > together else 0):
        sizes = entries.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > together)
        large = sizes.select("tree", "node").collect()  # at most all rows of all trees by `together`
        if not large:
            break
        chosen = F.broadcast(spark.createDataFrame(large, "tree INT, node BIGINT"))
        single = entries.join(chosen, ["tree", "node"]).select("tree", "node", F.posexplode("bins").alias("feature", "value"), "w", LABEL, "k")
        weighted = F.col("w") * F.col(LABEL)
        sums = single.groupBy("tree", "node", "feature", "value").agg(
            F.sum("w").alias("w"), F.sum(weighted).alias("s"), F.sum(weighted * F.col(LABEL)).alias("q"), F.sum("k").alias("k")
        )
        split = sums.groupBy("tree", "node").applyInArrow(lambda t: _split(t, limits, arity, leaf, least), NODES).toArrow()
        tops.append(split)
        found = F.broadcast(spark.createDataFrame(split.select(["tree", "node", "feature", "left"]), "tree INT, node BIGINT, feature INT, left ARRAY<DOUBLE>"))
        value = F.get("bins", F.col("feature"))
        of = F.get(F.array(*map(F.lit, arity)), F.col("feature"))
        edge = F.get(F.get(F.array(*(F.array(*map(F.lit, c)).cast("array<double>") for c in limits)), F.col("feature")), value)
        # A number's bin goes left where its upper edge is no higher than the threshold; the last bin has none.
        goes = F.when(of > 0, F.array_contains("left", value.cast("double"))).otherwise(F.coalesce(edge <= F.col("left")[0], F.lit(False)))
        child = F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(goes, 0).otherwise(1))
        entries = entries.join(found, ["tree", "node"], "left").filter("feature IS NULL OR feature >= 0")
        entries = entries.select("tree", child.alias("node"), "bins", "w", LABEL, "k")
    cores = spark.sparkContext.defaultParallelism
    parts = max(min(4 * cores, trees if size <= together else 4 * cores), math.ceil(size * trees / PARTITION))
    nodes = entries.repartition(parts, "tree", "node").groupBy("tree", "node").applyInArrow(lambda t: _subtree(t, limits, arity, depth, leaf, least), NODES)
    return nodes.unionByName(spark.createDataFrame(pa.concat_tables(tops), NODES)) if tops else nodes


def _walk(nodes: pa.Table, limits, arity: Sequence[int]) -> tuple[np.ndarray, ...]:
    """A tree for `_answers`: of each node the feature, the first child (the other one is next), the answer, and where its part
    of the last array begins, which says for every bin whether it goes left."""
    nodes = nodes.sort_by("node")
    ids, feature = (nodes[c].to_numpy() for c in ("node", "feature"))
    value = nodes["total"].to_numpy() / nodes["weight"].to_numpy()
    wide = np.array([n or len(at) + 1 for n, at in zip(arity, limits, strict=True)])
    inner = np.flatnonzero(feature >= 0)
    ends = np.cumsum(wide[feature[inner]])
    begin, child = np.zeros(len(ids), np.int64), np.searchsorted(ids, 2 * ids)
    begin[inner] = ends - wide[feature[inner]]
    goes, left = np.zeros(ends[-1] if len(inner) else 0, bool), nodes["left"].combine_chunks()
    first, values = left.offsets.to_numpy(), left.values.to_numpy(zero_copy_only=False)
    for f, categories in enumerate(arity):
        mine = inner[feature[inner] == f]
        if categories:
            sizes = first[mine + 1] - first[mine]
            at = np.repeat(first[mine] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            goes[np.repeat(begin[mine], sizes) + values[at].astype(np.int64)] = True
        elif len(mine):
            edge = np.append(np.asarray(limits[f], float), np.inf)  # the last bin has no upper edge
            goes[begin[mine][:, None] + np.arange(len(edge))] = edge <= values[first[mine]][:, None]
    return feature, child, value, begin, goes


def _answers(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """What a tree answers for the rows with these bins (one line a feature)."""
    feature, child, value, begin, goes = tree
    at, row = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    while len(row := row[feature[at[row]] >= 0]):
        here = at[row]
        at[row] = child[here] + ~goes[begin[here] + bins[feature[here], row]]
    return value[at]


def boosted(
    rows: DataFrame, arity: Sequence[int], bins: int, rounds: int, step: float, depth: int, leaf: float, together: int = ALONE, kept: int = KEPT
) -> DataFrame:
    """The nodes (`NODES`) of boosted trees, a tree a round: the first one is grown on the labels, each other on twice what those
    before it leave of them, and counts `step` times. Rows carry the answers so far, written every `kept` rounds."""
    spark, limits = rows.sparkSession, strides(rows, arity, bins)
    state = _binned(rows, limits, arity).select("bins", "w", LABEL, F.lit(0.0).alias("answer"))
    size = state.count()
    found, shared = [], {}

    def after(state: DataFrame) -> DataFrame:
        trees, weights = list(shared.values()), [step if m else 1.0 for m in shared]

        def run(batches):
            for batch in batches:
                answer, at = batch["answer"].to_numpy(), batch["bins"].flatten().to_numpy().reshape(-1, len(arity)).T
                for weight, tree in zip(weights, trees, strict=True):
                    answer = answer + weight * _answers(tree.value, at)
                yield pa.RecordBatch.from_arrays([batch["bins"], batch["w"], batch[LABEL], pa.array(answer)], ["bins", "w", LABEL, "answer"])

        return state.mapInArrow(run, state.schema) if trees else state

    for m in range(rounds):
        now = after(state)
        if m % kept == 0:
            state = now = now.checkpoint()
            while shared:
                shared.popitem()[1].destroy()
        label = 2 * (F.col(LABEL) - F.col("answer")) if m else F.col(LABEL)
        entries = now.select(F.lit(m).alias("tree"), F.lit(1).cast("long").alias("node"), "bins", "w", label.alias(LABEL), F.lit(1).alias("k"))
        # A table, of which the driver needs the trees since the last checkpoint alone.
        found.append(_nodes(entries, size, 1, limits, arity, depth, leaf, 0, together).checkpoint())
        shared[m] = spark.sparkContext.broadcast(_walk(found[-1].toArrow(), limits, arity))
    while shared:
        shared.popitem()[1].destroy()
    return reduce(DataFrame.unionByName, found)


def saved(nodes: DataFrame, arity: Sequence[int]) -> DataFrame:
    """Nodes as Spark ML saves them. Numbered in the order of `node`, the children of split node j of a tree have the
    numbers 2 j + 1 and 2 j + 2."""
    order = Window.partitionBy("tree").orderBy("node")
    inner = F.col("feature") >= 0
    j = F.sum(inner.cast("int")).over(order) - 1
    mean = F.col("total") / F.col("weight")
    categories = F.get(F.array(*(F.lit(a or -1) for a in arity)), F.col("feature"))
    data = F.struct(
        (F.row_number().over(order) - 1).alias("id"),
        mean.alias("prediction"),
        F.greatest(F.col("squares") / F.col("weight") - mean * mean, F.lit(0.0)).alias("impurity"),
        F.array("weight", "total", "squares").alias("impurityStats"),
        F.col("rows").alias("rawCount"),
        F.col("gain"),
        F.when(inner, 2 * j + 1).otherwise(-1).cast("int").alias("leftChild"),
        F.when(inner, 2 * j + 2).otherwise(-1).cast("int").alias("rightChild"),
        F.struct(
            F.col("feature").alias("featureIndex"), F.col("left").alias("leftCategoriesOrThreshold"), F.when(inner, categories).otherwise(-1).alias("numCategories")
        ).alias("split"),
    )
    return nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData"))
