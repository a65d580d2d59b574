"""Well-rated order classifier (M11-M20): training set, one-hot, split, weighted tree, reports.

* Training set: fact ⋈ product ⋈ client, rated items with a positive delay; label
  ``bonne_note = score >= 4`` on the order-averaged score (items of one order share it).
* One-hot with the first level (alphabetical) of each categorical dropped, as the source's
  dummies. Like the source, the levels come from all rows, before the split.
* Stratified split (exact per-class test sizes ``ceil(share * n_class)``, seeded and
  engine independent): each row's rank inside its class is by ``md5(key || seed)``. Rather
  than a window over a whole class (half the data in one task), the cut is found digit by digit: a
  count of the next hex digit below the current prefix (16 rows per class, combined map-side) says
  in which bucket the cut lies, until that bucket has at most ``EDGE_BUCKET_ROWS`` rows; only these
  are ranked by a window.
* Class weights ``n / (2 n_class)`` (the "balanced" rule) weigh the classes in the tree.
* Tree: every threshold of every feature is tried (``operators.tree``), depth 5; the tree is a relation, predictions are joins down its
  levels, importances an aggregate over it. Reports are aggregates over the predictions (accuracy, per-class
  precision/recall/F1/support, confusion).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etoile.operators import kpis, tree
from etoile.session import materialize

NUMERIC = ["prix_unitaire", "frais_livraison", "delai_livraison_jours"]
CATEGORICAL = ["categorie", "region"]
LABEL = "bonne_note"
KEY = ["commande_id", "item_id"]
TEST_SHARE = 0.25
SEED = 42
MAX_DEPTH = 5
TOP_FEATURES = 10
GOOD_SCORE = 4
EDGE_BUCKET_ROWS = 100_000   # rows ranked by the one window (the bucket holding the cut)
MAX_HEX_DIGITS = 32
# The report's class names.
CLASS_NAMES = {0: "Mauvaise note (< 4)", 1: "Bonne note (≥ 4)"}


def training_set(fact: DataFrame, dim_produit: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Rated items with a positive delay, with category, region and the label."""
    f = (fact.filter(F.col("score_satisfaction").isNotNull() & (F.col("delai_livraison_jours") > 0)))
    f = kpis.with_clients(kpis.with_products(f, dim_produit, "categorie"), dim_client, "region")
    return f.select(*KEY, "score_satisfaction", *NUMERIC, *CATEGORICAL,
                    (F.col("score_satisfaction") >= GOOD_SCORE).cast("int").alias(LABEL))


def onehot_levels(train: DataFrame, cols=CATEGORICAL) -> DataFrame:
    """The dummy columns kept: ``(variable, niveau, colonne)``, first level dropped."""
    parts = []
    for c in cols:
        levels = train.select(F.col(c).alias("niveau")).distinct()      # distinct levels: bounded
        kept = (levels.withColumn("_first", F.min("niveau").over(Window.partitionBy()))
                .filter(F.col("niveau") != F.col("_first")))
        parts.append(kept.select(F.lit(c).alias("variable"), "niveau",
                                 F.concat(F.lit(c + "_"), F.col("niveau")).alias("colonne")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("variable", "niveau")


def _hash(key_cols, seed) -> F.Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols], F.lit(str(seed))))


def _cuts(h: DataFrame, label: str, test_share: float, edge_rows: int) -> dict:
    """Per class: ``(prefix, before, wanted)``; the cut lies in the bucket ``prefix``, after ``before`` smaller rows."""
    sizes = {r[0]: r["nb"] for r in h.groupBy(label).agg(F.count(F.lit(1)).alias("nb")).collect()}     # one row per class
    cuts = {c: ("", 0, math.ceil(n * test_share)) for c, n in sizes.items()}
    held = dict(sizes)
    for digits in range(1, MAX_HEX_DIGITS + 1):
        wide = [c for c in cuts if held[c] > edge_rows]
        if not wide:
            break
        inside = reduce(Column.__or__, [F.col(label).eqNullSafe(F.lit(c)) & F.col("_h").startswith(cuts[c][0]) for c in wide])
        rows = (h.filter(inside).groupBy(label, F.substring("_h", 1, digits).alias("_b"))
                .agg(F.count(F.lit(1)).alias("nb")).collect())                                             # 16 per class
        for c in wide:
            prefix, before, wanted = cuts[c]
            for r in sorted((r for r in rows if r[0] == c), key=lambda r: r["_b"]):
                prefix, held[c] = r["_b"], r["nb"]
                if before + r["nb"] >= wanted:
                    break
                before += r["nb"]
            cuts[c] = (prefix, before, wanted)
    return cuts


def stratified_split(df: DataFrame, label: str = LABEL, key_cols=KEY, test_share: float = TEST_SHARE,
                     seed: int = SEED, edge_rows: int = EDGE_BUCKET_ROWS) -> DataFrame:
    """Adds ``is_test``: per class, the ``ceil(test_share * n)`` rows of smallest hash.

    Ties on the hash (duplicate keys) are broken by the key columns. The hashed input is
    written once as a table in the checkpoint folder, and the cuts are counted, while the frame is
    built: one computation of the joins behind it, whatever reads the split next.
    """
    h = materialize(df.withColumn("_h", _hash(key_cols, seed)), "split-input")
    edge, test = F.lit(False), F.lit(False)
    before, wanted = F.lit(0), F.lit(0)
    for c, (prefix, rows, want) in _cuts(h, label, test_share, edge_rows).items():
        own, head = F.col(label).eqNullSafe(F.lit(c)), F.substring("_h", 1, len(prefix))
        edge = F.when(own, head == prefix).otherwise(edge)
        test = F.when(own, head < prefix).otherwise(test)
        before, wanted = F.when(own, rows).otherwise(before), F.when(own, want).otherwise(wanted)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", *key_cols))
    near = h.filter(edge).withColumn("is_test", (rank + before) <= wanted)
    rest = h.filter(~edge).withColumn("is_test", test)
    return near.unionByName(rest).drop("_h")


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """``(label, nb, poids)`` with ``poids = n / (n_classes * n_class)``."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("nb"))   # one row per class
    every = Window.partitionBy()
    return (counts.select(label, "nb", (F.sum("nb").over(every)
                                        / (F.count(F.lit(1)).over(every) * F.col("nb"))).alias("poids"))
            .orderBy(label))


def grower(split: DataFrame) -> tree.Grower:
    """M13, M15 for the tree: each categorical's first level (over all rows, as the source encodes before splitting) and the class weights of the training part."""
    first = split.agg(*[F.min(F.col(c).cast("string")).alias(c) for c in CATEGORICAL]).first()
    weights = {r[LABEL]: r["poids"] for r in class_weights(split.filter(~F.col("is_test"))).collect()}      # one row per class
    return tree.Grower(LABEL, {c: weights.get(c, 0.0) for c in CLASS_NAMES}, NUMERIC, {c: first[c] for c in CATEGORICAL})


def fit_tree(split: DataFrame, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """The balanced-weight tree of the training part (a relation, see ``operators.tree``) and
    ``(commande_id, item_id, bonne_note, prediction)`` on the test part."""
    g = grower(split)
    nodes = g.grow(split.filter(~F.col("is_test")), max_depth)
    pred = g.predict(split.filter(F.col("is_test")), nodes, max_depth)
    return nodes, pred.select(*KEY, LABEL, "prediction")


def accuracy(pred: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of correct predictions."""
    return pred.agg(F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("precision_globale"))


def confusion(pred: DataFrame, label: str = LABEL, classes=(0, 1)) -> DataFrame:
    """Counts for every (actual, predicted) pair of the 2 x 2 grid, zeros included."""
    grid = pred.sparkSession.createDataFrame([(a, p) for a in classes for p in classes], f"{label} int, prediction int")
    counts = pred.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("nb"))
    return (F.broadcast(grid).join(counts, [label, "prediction"], "left")
            .select(label, "prediction", F.coalesce("nb", F.lit(0)).cast("long").alias("nb"))
            .orderBy(label, "prediction"))


def report(pred: DataFrame, label: str = LABEL, classes=(0, 1)) -> DataFrame:
    """Per class precision, recall, F1 and support, the accuracy line, then macro and weighted averages."""
    y, p = F.col(label), F.col("prediction")
    aggs = []
    for c in classes:
        aggs += [F.count(F.when((y == c) & (p == c), 1)).alias(f"tp{c}"),
                 F.count(F.when(p == c, 1)).alias(f"pp{c}"),
                 F.count(F.when(y == c, 1)).alias(f"sup{c}")]
    s = pred.agg(*aggs)
    rows = []
    for c in classes:
        prec = F.when(F.col(f"pp{c}") > 0, F.col(f"tp{c}") / F.col(f"pp{c}")).otherwise(F.lit(0.0))
        rec = F.when(F.col(f"sup{c}") > 0, F.col(f"tp{c}") / F.col(f"sup{c}")).otherwise(F.lit(0.0))
        rows.append(s.select(F.lit(CLASS_NAMES.get(c, str(c))).alias("classe"), prec.alias("precision"), rec.alias("rappel"),
                             F.col(f"sup{c}").alias("support")))
    per = rows[0]
    for r in rows[1:]:
        per = per.unionByName(r)
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("rappel") > 0,
                                      2 * F.col("precision") * F.col("rappel") / (F.col("precision") + F.col("rappel")))
                         .otherwise(F.lit(0.0)))
    n = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("classe"), F.avg("precision").alias("precision"),
                    F.avg("rappel").alias("rappel"), n.alias("support"), F.avg("f1").alias("f1"))
    weighted = per.agg(F.lit("weighted avg").alias("classe"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("rappel") * F.col("support")) / n).alias("rappel"), n.alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"))
    hits = reduce(Column.__add__, [F.col(f"tp{c}") for c in classes])
    total = reduce(Column.__add__, [F.col(f"sup{c}") for c in classes])
    share = F.when(total > 0, hits / total)
    right = s.select(F.lit("accuracy").alias("classe"), share.alias("precision"), share.alias("rappel"),
                     total.alias("support"), share.alias("f1"))
    return per.unionByName(right).unionByName(macro).unionByName(weighted)


def feature_names(split: DataFrame) -> DataFrame:
    """``(variable)``: the numeric columns and the dummies, named as in ``onehot_levels``."""
    numeric = split.sparkSession.createDataFrame([(c,) for c in NUMERIC], "variable string")
    return numeric.unionByName(onehot_levels(split).select(F.col("colonne").alias("variable")))


def rule_predictions(split: DataFrame, max_delay: float) -> DataFrame:
    """Predictions of a stated rule on the test part (good if the delay is at most ``max_delay``), in the form of ``fit_tree``'s."""
    good = (F.col("delai_livraison_jours") <= max_delay).cast("int")
    return split.filter(F.col("is_test")).select(*KEY, LABEL, good.alias("prediction"))


def importances(nodes: DataFrame, split: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """The ``top`` feature importances, 4 decimals, largest first."""
    shares = tree.importances(nodes, feature_names(split)).select("variable", F.round("importance", 4).alias("importance"))
    return shares.orderBy(F.desc("importance"), F.asc("variable")).limit(top)
