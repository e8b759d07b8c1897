"""Least squares on several categoricals of any size, by conjugate gradients over effect tables.

The unknowns are rows (feature, key, ...): one for each category, and one for each number. A product with the
normal equations is a join of the trips' moments with the direction of every feature, and one aggregation
back to the categories; steps come from sums over that table. So categories never pass through the driver,
which holds a handful of sums and the slopes. One job a round, over one row per combination of categories;
the columns are centred and scaled by their weights, so the rounds depend on how well trips connect the
categories, not on how uneven they are.

What least squares leaves open, shifts between the features of an island, is settled by least norm: the
islands are labelled and averaged as tables, too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import required
from kerbside.operators.encode import FeatureSpec
from kerbside.session import Scratch, ensure_checkpoint_dir

# Residual, as a share of the first one, at which the rounds end.
TOLERANCE = 1e-10
ROUNDS = 1000
# Rows of the unknowns of one feature that are sent to all executors instead of joined by key.
MAX_BROADCAST = 500_000


@dataclass
class Solution:
    intercept: float
    slopes: dict[str, float]
    effects: dict[str, DataFrame]  # key, effect


def solve(rows: DataFrame, spec: FeatureSpec, weight: str, label: str, tolerance: float = TOLERANCE) -> Solution:
    """`rows` have the inputs of `spec`, a weight and a label; two categoricals are brought to least norm on
    every island, more of them lose their means."""
    ensure_checkpoint_dir(rows.sparkSession)
    names, numbers = list(spec.categorical), list(spec.numerical)
    keys = [f"_key{i}" for i in range(len(names))]
    typed = rows.select(
        *(spec.key(c).alias(k) for c, k in zip(names, keys, strict=True)),
        *(required(n).alias(f"_x{i}") for i, n in enumerate(numbers)),
        F.col(weight).cast("double").alias("_w"),
        F.col(label).cast("double").alias("_y"),
    )
    at = [F.sum(F.col("_w") * F.col(f"_x{i}")).alias(f"x{i}") for i in range(len(numbers))]
    sums = typed.agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_y")).alias("y"), *at).first()
    mean_y, mean_x = sums["y"] / sums["w"], [sums[f"x{i}"] / sums["w"] for i in range(len(numbers))]
    centred = [F.col(f"_x{i}") - F.lit(m) for i, m in enumerate(mean_x)]
    typed = typed.select(*keys, *(c.alias(f"_x{i}") for i, c in enumerate(centred)), "_w", (F.col("_y") - F.lit(mean_y)).alias("_y"))
    typed = typed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with Scratch(rows.sparkSession) as scratch:
            state = _conjugate_gradients(typed, keys, len(numbers), tolerance, scratch)
            slopes = dict.fromkeys(range(len(numbers)), 0.0) | {r.feature - len(names): r.x for r in state.filter(F.col("feature") >= len(names)).select("feature", "x").collect()}
            effects = [state.filter(F.col("feature") == i).select("key", "d", F.col("x").alias("effect")) for i in range(len(names))]
            above = sum(e.agg(F.sum(F.col("d") * F.col("effect")) / F.sum("d")).first()[0] for e in effects)
            intercept = mean_y - above - sum(slopes[i] * m for i, m in enumerate(mean_x))
            moved, effects = _least_norm([e.drop("d") for e in effects], typed, keys, scratch)
            found = {c: e.checkpoint() for c, e in zip(names, effects, strict=True)}
        return Solution(intercept + moved, {n: slopes[i] for i, n in enumerate(numbers)}, found)
    finally:
        typed.unpersist()


def _back(rows: DataFrame, keys: Sequence[str], numbers: int, value) -> DataFrame:
    """(feature, key, d, s): the weight of each unknown's column and its product with `value`."""
    w = F.col("_w")
    entries = [F.struct(F.lit(i).alias("feature"), F.col(k).alias("key"), w.alias("d"), (w * value).alias("s")) for i, k in enumerate(keys)]
    for i in range(numbers):
        x = F.col(f"_x{i}")
        entries.append(F.struct(F.lit(len(keys) + i).alias("feature"), F.lit("").alias("key"), (w * x * x).alias("d"), (w * x * value).alias("s")))
    # Each task sums before it sends: a category with a third of the weight is a row a task.
    return rows.select(F.explode(F.array(*entries)).alias("_e")).groupBy("_e.feature", "_e.key").agg(F.sum("_e.d").alias("d"), F.sum("_e.s").alias("s"))


def _conjugate_gradients(rows: DataFrame, keys: Sequence[str], numbers: int, tolerance: float, scratch: Scratch) -> DataFrame:
    """(feature, key, d, x) at the solution, from zero."""
    category = F.col("feature") < len(keys)
    start = _back(rows, keys, numbers, F.col("_y")).filter("d > 0")  # a number that never varies has no slope
    state = scratch.cut(start.select("feature", "key", "d", F.lit(0.0).alias("x"), F.col("s").alias("r"), (F.col("s") / F.col("d")).alias("p")))
    sizes = {r.feature: r.n for r in state.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    slope = {r.feature: r.p for r in state.filter(~category).select("feature", "p").collect()}
    first = None
    for _ in range(ROUNDS):
        product, joined = F.lit(0.0), rows
        for i, k in enumerate(keys):
            step = state.filter(F.col("feature") == i).select(F.col("key").alias(k), F.col("p").alias(f"_p{i}"))
            joined = joined.join(F.broadcast(step) if sizes[i] <= MAX_BROADCAST else step, k)
            product += F.col(f"_p{i}")
        for i in range(numbers):
            product += F.lit(slope.get(len(keys) + i, 0.0)) * F.col(f"_x{i}")
        back = _back(joined, keys, numbers, product).drop("d")
        now = scratch.cut(state.join(back, ["feature", "key"]))  # the next round starts from this table
        p, r, d, s, one = (F.col(c) for c in ("p", "r", "d", "s", "feature"))
        among = lambda c: F.sum(F.when(category, c)).alias
        picked = [F.struct(*(F.max(F.when(one == f, F.col(c))).alias(c) for c in "prds")).alias(f"n{f}") for f in slope]
        t = now.agg(
            F.sum(F.when(one == 0, s)).alias("all_s"), F.sum(F.when(one == 0, d)).alias("all_d"), F.sum(r * r / d).alias("rr"),
            F.sum(p * s).alias("ps"), among(p * d)("pd"), F.sum(r * s / d).alias("rs"), among(r)("r"), F.sum(s * s / d).alias("ss"), among(s)("s"), among(d)("d"), *picked,
        ).first()
        first = first or t.rr
        if not t.rr or t.rr <= tolerance * tolerance * first:
            break
        mean = t.all_s / t.all_d  # the product is centred, as the columns are
        along = t.ps - mean * t.pd
        alpha = t.rr / along
        rest = t.rr - 2 * alpha * (t.rs - mean * t.r) + alpha * alpha * (t.ss - 2 * mean * t.s + mean * mean * t.d)
        beta = max(rest, 0.0) / t.rr
        less = s - F.when(category, d * F.lit(mean)).otherwise(F.lit(0.0))
        new_r = r - F.lit(alpha) * less
        state = now.select("feature", "key", "d", (F.col("x") + F.lit(alpha) * p).alias("x"), new_r.alias("r"), (new_r / d + F.lit(beta) * p).alias("p"))
        slope = {f: (t[f"n{f}"].r - alpha * t[f"n{f}"].s) / t[f"n{f}"].d + beta * t[f"n{f}"].p for f in slope}
    return state.select("feature", "key", "d", "x")


def _least_norm(effects: list[DataFrame], rows: DataFrame, keys: Sequence[str], scratch: Scratch) -> tuple[float, list[DataFrame]]:
    """What moves to the intercept, and the effects shifted to the least sum of squares.

    On an island all effects of one feature may rise and all of the other fall by as much, and the sum of
    both may move to the intercept, by the same amount on every island.
    """
    if len(effects) != 2:
        means = [e.agg(F.avg("effect")).first()[0] for e in effects]
        return sum(means), [e.select("key", (F.col("effect") - F.lit(m)).alias("effect")) for e, m in zip(effects, means, strict=True)]
    islands = _islands(rows.select(*keys).distinct(), *keys, scratch)
    placed = [e.join(i, "key") for e, i in zip(effects, islands, strict=True)]
    sides = [p.groupBy("island").agg(F.count("*").alias(f"n{k}"), F.avg("effect").alias(f"mean{k}")) for k, p in enumerate(placed)]
    per = scratch.cut(sides[0].join(sides[1], "island").withColumn("sum", F.col("mean0") + F.col("mean1")))
    # With s moved to the intercept an island's means become shares of sum - s, at the cost of its square
    # times n * m / (n + m): so s is a weighted mean.
    pull = F.col("n0") * F.col("n1") / (F.col("n0") + F.col("n1"))
    moved = per.agg(F.sum(pull * F.col("sum")) / F.sum(pull)).first()[0]
    out = []
    for k, p in enumerate(placed):
        share = F.col(f"n{1 - k}") / (F.col("n0") + F.col("n1"))
        shift = per.select("island", ((F.col("sum") - F.lit(moved)) * share - F.col(f"mean{k}")).alias("shift"))
        out.append(p.join(shift, "island").select("key", (F.col("effect") + F.col("shift")).alias("effect")))
    return moved, out


def _islands(edges: DataFrame, a: str, b: str, scratch: Scratch) -> list[DataFrame]:
    """(key, island) of both features: the connected part of the graph of categories that meet in a trip.

    Each side takes the smallest label of its neighbours until none changes; a pointer to the label's own
    label makes long chains short.
    """
    edges = scratch.cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")))
    of_a, before = scratch.cut(edges.groupBy("a").agg(F.min("b").alias("island"))), None
    while True:
        of_b = edges.join(of_a, "a").groupBy("b").agg(F.min("island").alias("island"))
        # A label is the name of a category of b, which has a label of its own by now.
        jump = of_b.select(F.col("b").alias("island"), F.col("island").alias("further"))
        of_b = scratch.cut(of_b.join(jump, "island", "left").select("b", F.least("island", F.coalesce("further", "island")).alias("island")))
        of_a = scratch.cut(edges.join(of_b, "b").groupBy("a").agg(F.min("island").alias("island")))
        now = reduce(lambda x, y: (*x, *y), [tuple(t.agg(F.count_distinct("island"), F.sum(F.xxhash64(c, "island").cast("decimal(38,0)"))).first()) for t, c in ((of_a, "a"), (of_b, "b"))])
        if now == before:
            return [of_a.select(F.col("a").alias("key"), "island"), of_b.select(F.col("b").alias("key"), "island")]
        before = now
