"""Customer segmentation (M1-M10): client profile, z-scores, K-Means, labelled segments.

* The profile is one aggregate per client (the distinct-order count plans as a two-level
  aggregate keyed by client then order, combined map-side).
* Z-scores use population statistics, as the source's scaler does; the global means and
  standard deviations are one aggregate row, applied as literals.
* K-Means: the source keeps the best of ``n_init`` k-means++ restarts for each k. All
  restarts (and, for the elbow curve, all values of k) advance together in
  ``etoile.operators.kmeans``: one pass over the features per Lloyd iteration for every
  fit, instead of one pass per iteration per fit.
* The feature frame is written once as a table in ``spark.checkpoint.dir``: every pass
  reads it instead of recomputing the star, and a lost executor costs a re-read, not a
  re-run of the ETL.
* Segment labels go by rank of mean revenue (smallest = segment 1), ties by cluster id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etoile.operators import kmeans, kpis
from etoile.session import materialize

FEATURES = ["freq_achat", "montant_moyen", "ca_total"]
Z_FEATURES = [f"z_{c}" for c in FEATURES]
K = 4
K_RANGE = range(2, 9)
N_INIT = 10
SEED = 42
SAMPLE_SIZE = 3000
MAX_ITER = 300
TOL = 1e-4
# Segment label by rank of mean revenue (1 = smallest).
SEGMENT_LABELS = [
    "Segment 1 — Petits acheteurs",
    "Segment 2 — Occasionnels",
    "Segment 3 — Réguliers",
    "Segment 4 — Grands comptes",
]


def client_profile(fact: DataFrame) -> DataFrame:
    """M1: per client: distinct orders, mean item price, revenue, mean score, mean delay.

    The mean delay has no positive-delay filter here (unlike the KPIs), as in the source.
    """
    m = kpis.measures(fact)
    return (fact.groupBy("client_id").agg(
        m["commandes"].alias("freq_achat"), m["panier"].alias("montant_moyen"), m["ca"].alias("ca_total"),
        m["score"].alias("score_moyen"), m["delai"].alias("delai_moyen"))
        .filter(F.col("freq_achat") >= 1))


def feature_matrix(profile: DataFrame, features=FEATURES) -> DataFrame:
    """M2: features with missing values as 0."""
    return profile.select("client_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                         for c in features])


def zscores(features: DataFrame, cols=FEATURES) -> DataFrame:
    """M3: ``(x - mean) / std_pop`` per feature; a constant feature gives 0.

    The means and standard deviations are one global aggregate (2 numbers per feature),
    fetched and applied as literals, as a fitted scaler does: no join, no window. That is a job
    while the plan is built, so ``features`` should be a written table (``client_zscores``).
    """
    stats = features.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                         *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    def z(c):
        m, sd = stats[f"m_{c}"], stats[f"s_{c}"]
        if not sd:
            return F.lit(0.0)
        return (F.col(c) - F.lit(float(m))) / F.lit(float(sd))
    return features.select("client_id", *cols, *[z(c).alias(f"z_{c}") for c in cols])


def client_zscores(fact: DataFrame) -> DataFrame:
    """M1-M3 with the feature table written once: statistics, fits and assignments all read it."""
    return zscores(materialize(feature_matrix(client_profile(fact)), "features"))


def _models(k_range, n_init: int, seed: int) -> list[tuple[int, int]]:
    return [(k, s) for k in k_range for s in range(seed, seed + n_init)]


def elbow_curve(z: DataFrame, k_range=K_RANGE, n_init: int = N_INIT, seed: int = SEED,
                max_iter: int = MAX_ITER, tol: float = TOL) -> DataFrame:
    """M4: ``(k, inertie)`` for each k, best of ``n_init`` restarts (all fits in shared passes)."""
    fits = kmeans.fit_many(z, Z_FEATURES, _models(k_range, n_init, seed), max_iter, tol)
    rows = [(k, float(f.cost)) for k, f in sorted(kmeans.best_per_k(fits).items())]
    return z.sparkSession.createDataFrame(rows, "k int, inertie double")


def segment(z: DataFrame, k: int = K, n_init: int = N_INIT, seed: int = SEED, max_iter: int = MAX_ITER,
            tol: float = TOL) -> tuple[DataFrame, kmeans.KMeansFit]:
    """M5-M7: cluster id and label per client; returns the frame and the chosen fit."""
    best = kmeans.best_per_k(kmeans.fit_many(z, Z_FEATURES, _models([k], n_init, seed), max_iter, tol))[k]
    return label_segments(z, best.centers), best


def label_segments(z: DataFrame, centers) -> DataFrame:
    """M5-M7 for given centers: nearest center (ties to the lower index) and the label by rank of mean revenue."""
    clustered = kmeans.assign(z, Z_FEATURES, centers)
    means = clustered.groupBy("segment").agg(*[F.avg(c).alias(f"_m_{c}") for c in FEATURES])
    rank = F.row_number().over(Window.orderBy(F.col("_m_ca_total").asc(), F.col("segment").asc()))
    labels = F.array(*[F.lit(x) for x in SEGMENT_LABELS])
    names = means.select("segment", F.element_at(labels, rank).alias("segment_label"))  # k rows
    out = clustered.join(F.broadcast(names), "segment")
    return out.select("client_id", *FEATURES, *Z_FEATURES, "segment", "segment_label")


def inertia(z: DataFrame, centers) -> DataFrame:
    """M4 for given centers: summed squared distance of the clients to their nearest center."""
    return kmeans.inertia(z, Z_FEATURES, centers)


def segment_summary(segments: DataFrame) -> DataFrame:
    """M8: mean features per segment, 2 decimals."""
    return (segments.groupBy("segment_label")
            .agg(*[F.round(F.avg(c), 2).alias(c) for c in FEATURES]).orderBy("segment_label"))


def segment_sizes(segments: DataFrame) -> DataFrame:
    """M9: clients per segment, largest first."""
    return (segments.groupBy("segment_label").agg(F.count(F.lit(1)).alias("nb_clients"))
            .orderBy(F.desc("nb_clients"), F.asc("segment_label")))


def client_sample(profile: DataFrame, n: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """A seeded sample of at most ``n`` clients (for the scatter chart).

    The sample is the ``n`` smallest ``md5(client_id || seed)``: deterministic, engine
    independent, and planned as a top-k (each partition keeps n rows), not a global sort.
    """
    h = F.md5(F.concat(F.col("client_id").cast("string"), F.lit(str(seed))))
    return profile.withColumn("_h", h).orderBy("_h", "client_id").limit(n).drop("_h")


def segment_sample(profile: DataFrame, segments: DataFrame, n: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """M10 as exported: the sampled clients with their segment and label."""
    sample = F.broadcast(client_sample(profile, n, seed))                  # n rows
    return segments.select("client_id", "segment", "segment_label").join(sample, "client_id").select(
        *profile.columns, "segment", "segment_label")
