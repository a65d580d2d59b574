"""Exact decision tree (M16) as a relation, with its predictions (M16) and importances (M20) as joins and aggregates.

*Search.* A tree grows level by level; every threshold between neighbouring values counts. Each numeric feature's range is cut into ``SLICES`` slices (bounds by approximate
quantiles; they decide the work, not the result). Two passes over the rows of a level's open nodes:

1. Counts per class of every (node, feature, slice), with the slice's least and largest value, combined before their exchange, and of every dummy's level. Running sums over the slices
   give the exact gain of each threshold between two slices. A dummy's one threshold is 0.5: the rows of its level go right, what the node has besides goes left.
2. Inside a slice, the counts that go left lie between those before it and those up to its end. The gain is convex in these counts, so it is at most that of the best corner of this box
   (2^classes corners). Only slices whose box reaches the best gain of pass 1 are opened: counts of each of their values, and running sums inside each slice. The others hold no better
   threshold and no tie. If all are opened, this is the full search over every value, in slices; no task holds a feature's values.

Best is the largest ``sum of squared class weights / weight`` over both sides (least Gini impurity); ties go to the first feature, then level, then threshold.

*Relation.* One row per node: number (1 is the root, 2n and 2n+1 the children of n), depth, variable, level (dummies), threshold, whether it is a leaf, counts per class, weight, Gini impurity,
prediction (larger weight; a tie: the first class). At most 2^(depth+1) - 1 rows: that bounds what reaches the driver and every broadcast here.

*Rules, as the source's defaults.* A node is a leaf at ``max_depth``, if one class is left, or if no feature has two values. Counts are whole numbers, so results do not
depend on partitions. The source rounds features to single precision before it splits; here they are double. A null number or NaN is below all others; a null category has no dummy.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etoile.session import dematerialize, materialize

DUMMY_CUT = 0.5
SLICES, QUANTILE_ACCURACY = 2048, 10_000
ROUNDING = 1e-12      # relative; far above the error of a gain in double precision
_LOW = float("-inf")


def _number(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(_LOW)).otherwise(v)


def _relation(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small relation that is part of the plan: reading it is no job."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = [c.split()[0] for c in schema.split(", ")]
    values = ", ".join("(" + ", ".join("NULL" if v is None else f":v{i}_{j}" for j, v in enumerate(r)) + ")" for i, r in enumerate(rows))
    given = {f"v{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r) if v is not None}
    kinds = [c.split()[1] for c in schema.split(", ")]
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})", args=given).select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)])


class Grower:
    """Features, classes and their weights; ``first_levels``: each categorical's level without a dummy."""

    def __init__(self, label: str, weights: dict[int, float], numeric: list[str], first_levels: dict[str, str | None]):
        self.label, self.weights, self.numeric, self.first_levels = label, dict(sorted(weights.items())), list(numeric), first_levels
        self.counts = [f"n_{c}" for c in self.weights]
        self.schema = ("node int, depth int, variable string, niveau string, seuil double, feuille boolean, " + ", ".join(f"{n} long" for n in self.counts)
                       + ", poids double, gini double, prediction int")

    # -------------------------------------------------------------- statistics of a level

    def _per_class(self) -> list[Column]:
        return [F.count(F.when(F.col(self.label) == c, 1)).alias(n) for c, n in zip(self.weights, self.counts)]

    def _sliced(self, rows: DataFrame, bounds: list[list[float]]) -> DataFrame:
        """``rows`` with each numeric feature's value ``_v`` and slice ``_s``, by position."""
        rows = rows.select("*", *[_number(c).alias(f"_v{i}") for i, c in enumerate(self.numeric)])
        if not self.numeric:
            return rows
        splits = [[_LOW, *(b or [0.0]), -_LOW] for b in bounds]
        return Bucketizer(splitsArray=splits, inputCols=[f"_v{i}" for i in range(len(splits))], outputCols=[f"_s{i}" for i in range(len(splits))]).transform(rows)

    def _cells(self) -> list[Column]:
        return [F.struct(F.lit(i).alias("feature"), F.col(f"_s{i}").cast("int").alias("slice"), F.col(f"_v{i}").alias("value"), F.lit(None).cast("string").alias("niveau"))
                for i in range(len(self.numeric))]

    def _runs(self, rows: DataFrame) -> DataFrame:
        """(node, feature, slice, level, counts, least, most): slices of the numeric features, levels of the others."""
        cells = self._cells()
        cells += [F.struct(F.lit(len(self.numeric) + i).alias("feature"), F.lit(None).cast("int").alias("slice"), F.lit(None).cast("double").alias("value"),
                           F.col(c).cast("string").alias("niveau")) for i, c in enumerate(self.first_levels)]
        long = rows.select("node", self.label, F.explode(F.array(*cells)).alias("cell")).select("node", self.label, "cell.*")
        return long.groupBy("node", "feature", "slice", "niveau").agg(*self._per_class(), F.min("value").alias("least"), F.max("value").alias("most"))

    def _ordered(self, runs: DataFrame) -> DataFrame:
        """Numeric runs with the counts before them and the next run's least value."""
        order = Window.partitionBy("node", "feature").orderBy("slice")                        # one row per slice
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        return runs.where(F.col("feature") < len(self.numeric)).select(
            "node", "feature", "slice", "least", "most", *self.counts, F.lead("least").over(order).alias("after"),
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"before_{n}") for n in self.counts])

    def _between(self, ordered: DataFrame) -> DataFrame:
        """(node, feature, niveau, seuil, counts at or below): thresholds between slices."""
        return ordered.where("after is not null").select("node", "feature", F.lit(None).cast("string").alias("niveau"), ((F.col("most") + F.col("after")) / 2).alias("seuil"),
                                                         *[(F.col(n) + F.col(f"before_{n}")).alias(n) for n in self.counts])

    def _promising(self, ordered: DataFrame, totals: DataFrame, first: DataFrame) -> DataFrame:
        """(node, feature, slice, counts before) of the slices that may hold a threshold as good as the best known."""
        reach = F.greatest(*[self._gain([F.col(f"before_{n}") + (F.col(n) if own else F.lit(0)) for n, own in zip(self.counts, corner)])
                             for corner in product((False, True), repeat=len(self.counts))])
        return (ordered.where("least < most").join(totals, "node").join(F.broadcast(first), "node", "left")
                .where(F.col("worse").isNull() | (reach >= -F.col("worse") * (1 - ROUNDING)))
                .select("node", "feature", "slice", *[f"before_{n}" for n in self.counts]))

    def _inside(self, rows: DataFrame, opened: DataFrame) -> DataFrame:
        """(node, feature, niveau, seuil, counts at or below): thresholds between neighbouring values of the opened slices."""
        long = rows.select("node", self.label, F.explode(F.array(*self._cells())).alias("cell")).select("node", self.label, "cell.feature", "cell.slice", "cell.value")
        values = (long.join(F.broadcast(opened), ["node", "feature", "slice"])
                  .groupBy("node", "feature", "slice", "value").agg(*self._per_class(), *[F.first(f"before_{n}").alias(f"before_{n}") for n in self.counts]))
        inside = Window.partitionBy("node", "feature", "slice").orderBy("value")
        values = values.select("node", "feature", "value", F.lead("value").over(inside).alias("next"),
                               *[(F.sum(n).over(inside) + F.col(f"before_{n}")).alias(n) for n in self.counts]).where("next is not null")
        return values.select("node", "feature", F.lit(None).cast("string").alias("niveau"), ((F.col("value") + F.col("next")) / 2).alias("seuil"), *self.counts)

    def _dummy_cuts(self, values: DataFrame, totals: DataFrame) -> DataFrame:
        kept = reduce(Column.__or__, [(F.col("feature") == len(self.numeric) + i) & (F.col("niveau") != F.lit(first))
                                      for i, first in enumerate(self.first_levels.values()) if first is not None], F.lit(False))
        return (values.where(kept).join(totals, "node")
                .select("node", "feature", "niveau", F.lit(DUMMY_CUT).alias("seuil"), *[(F.col(f"all_{n}") - F.col(n)).alias(n) for n in self.counts])
                .where(reduce(Column.__add__, [F.col(n) for n in self.counts]) > 0))

    def _side(self, counts: list[Column]) -> Column:
        """Squared class weights over the weight; 0 without weight."""
        w = [c * F.lit(x) for c, x in zip(counts, self.weights.values())]
        total = reduce(Column.__add__, w)
        return F.when(total > 0, reduce(Column.__add__, [x * x for x in w]) / total).otherwise(0.0)

    def _gain(self, left: list[Column]) -> Column:
        return self._side(left) + self._side([F.col(f"all_{n}") - c for n, c in zip(self.counts, left)])

    def _scored(self, cuts: DataFrame, totals: DataFrame) -> DataFrame:
        """``cuts`` with ``worse``, the negated gain."""
        return cuts.join(totals, "node").select("node", (-self._gain([F.col(n) for n in self.counts])).alias("worse"), "feature", "niveau", "seuil", *self.counts)

    def _best(self, rows: DataFrame, open_nodes: list[dict]) -> dict[int, dict]:
        """The split of each open node, with the counts that go left: one row a node is collected."""
        spark = rows.sparkSession
        totals = F.broadcast(_relation(spark, [(n["node"], *[n[c] for c in self.counts]) for n in open_nodes],
                                       "node int, " + ", ".join(f"all_{n} long" for n in self.counts)))           # at most 2^depth rows
        rows = rows.where(F.col("node").isin([n["node"] for n in open_nodes]))
        runs = materialize(self._runs(rows), "tree-runs")                                     # SLICES a feature and node, and the dummies' levels
        cuts = self._dummy_cuts(runs, totals)
        if self.numeric:
            ordered = self._ordered(runs)
            cuts = cuts.unionByName(self._between(ordered))
        cuts = self._scored(cuts, totals)
        if self.numeric:
            opened = self._promising(ordered, totals, cuts.groupBy("node").agg(F.min("worse").alias("worse")))
            cuts = cuts.unionByName(self._scored(self._inside(rows, opened), totals))
        best = cuts.groupBy("node").agg(F.min(F.struct("worse", "feature", "niveau", "seuil", *self.counts)).alias("s")).collect()
        dematerialize(runs)
        return {r.node: r.s.asDict() for r in best}

    # -------------------------------------------------------------- the tree

    def _node(self, node: int, counts: dict[str, int]) -> dict:
        w = [counts[n] * x for n, x in zip(self.counts, self.weights.values())]
        total = sum(w)
        gini = 1.0
        for x in w:
            gini -= (x / total) * (x / total) if total else 0.0
        return {"node": node, "depth": node.bit_length() - 1, "variable": None, "niveau": None, "seuil": None, "feuille": True, **counts, "poids": total,
                "gini": gini, "prediction": list(self.weights)[max(range(len(w)), key=lambda i: (w[i], -i))]}

    def grow(self, train: DataFrame, max_depth: int) -> DataFrame:
        """The tree of the training rows (label, features), as a relation."""
        spark = train.sparkSession
        rows = materialize(train.select(self.label, *self.numeric, *self.first_levels), "tree-rows").withColumn("node", F.lit(1))
        shares = F.expr("array(" + ", ".join(f"{i / SLICES}D" for i in range(1, SLICES)) + ")")
        quantiles = [F.percentile_approx(F.col(c).cast("double"), shares, QUANTILE_ACCURACY).alias(c) for c in self.numeric]
        found = rows.agg(*self._per_class(), *quantiles).first()                              # a number per feature and slice
        bounds = [sorted({b for b in found[c] or [] if math.isfinite(b)}) for c in self.numeric]
        rows = self._sliced(rows, bounds)
        tree = [self._node(1, {n: found[n] for n in self.counts})] if any(found[n] for n in self.counts) else []
        for depth in range(max_depth):
            open_nodes = [n for n in tree if n["depth"] == depth and sum(n[c] > 0 for c in self.counts) > 1]
            if not open_nodes:
                break
            best = self._best(rows, open_nodes)
            names = [*self.numeric, *self.first_levels]
            for n in open_nodes:
                if n["node"] in best:
                    s = best[n["node"]]
                    n.update(variable=names[s["feature"]], niveau=s["niveau"], seuil=s["seuil"], feuille=False)
                    tree += [self._node(2 * n["node"], {c: s[c] for c in self.counts}), self._node(2 * n["node"] + 1, {c: n[c] - s[c] for c in self.counts})]
            rows = self.descend(rows, _relation(spark, [tuple(n.values()) for n in tree], self.schema), depth)
        return _relation(spark, [tuple(n.values()) for n in sorted(tree, key=lambda n: n["node"])], self.schema)

    def descend(self, rows: DataFrame, tree: DataFrame, depth: int) -> DataFrame:
        """Rows with ``node`` moved from the split nodes of one level to their children; others stay."""
        splits = F.broadcast(tree.where((F.col("depth") == depth) & ~F.col("feuille")).select(F.col("node").alias("_split"), "variable", "niveau", "seuil"))
        value = reduce(lambda e, c: e.when(F.col("variable") == c, _number(c)), self.numeric[1:], F.when(F.col("variable") == self.numeric[0], _number(self.numeric[0]))) \
            if self.numeric else F.lit(0.0)
        for c in self.first_levels:
            has = F.coalesce(F.col(c).cast("string") == F.col("niveau"), F.lit(False)).cast("double")
            value = F.when(F.col("variable") == c, has).otherwise(value)
        child = 2 * F.col("node") + (value > F.col("seuil")).cast("int")
        columns = rows.columns
        # rows' own columns win over the splits' names
        return (rows.join(splits, rows["node"] == splits["_split"], "left")
                .withColumn("node", F.when(F.col("_split").isNull(), F.col("node")).otherwise(child)).select(*columns))

    def predict(self, rows: DataFrame, tree: DataFrame, max_depth: int) -> DataFrame:
        """``rows`` with ``prediction``: joined down the levels of the tree."""
        columns, out = rows.columns, rows.withColumn("node", F.lit(1))
        for depth in range(max_depth):
            out = self.descend(out, tree, depth)
        return out.join(F.broadcast(tree.select("node", "prediction")), "node", "left").select(*columns, "prediction")


def importances(tree: DataFrame, names: DataFrame) -> DataFrame:
    """(variable, importance) of every feature in ``names`` (variable): its share of the weighted impurity that the splits take away."""
    n = tree.select("node", "variable", "niveau", "feuille", (F.col("poids") * F.col("gini")).alias("impurity"))
    below = n.where("node > 1").groupBy(F.shiftright("node", 1).alias("node")).agg(F.sum("impurity").alias("left_over"))
    name = F.when(F.col("niveau").isNull(), F.col("variable")).otherwise(F.concat_ws("_", "variable", "niveau"))
    taken = (n.where("not feuille").join(below, "node").groupBy(name.alias("variable")).agg(F.sum(F.col("impurity") - F.col("left_over")).alias("taken")))
    every = Window.partitionBy()
    taken = taken.select("variable", F.when(F.sum("taken").over(every) > 0, F.col("taken") / F.sum("taken").over(every)).otherwise(0.0).alias("importance"))   # a row per split feature
    return names.join(F.broadcast(taken), "variable", "left").select("variable", F.coalesce("importance", F.lit(0.0)).alias("importance"))
