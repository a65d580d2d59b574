"""Quarterly revenue forecast (M21-M28): a least-squares line on the quarterly series.

The series has one row per quarter present (bounded by the calendar, not by the data),
so the ordinal index is a window over that small frame. The fit itself is one aggregate
of exact sums and a closed form: no ML stage, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etoile.operators import kpis

HORIZON = 2


def trend_index(fact: DataFrame, dim_temps: DataFrame) -> DataFrame:
    """Revenue per quarter and ``t`` = 0.. the ordinal of quarters present (gaps collapse)."""
    q = kpis.quarterly_revenue(fact, dim_temps, with_orders=False)
    w = Window.orderBy("annee", "trimestre")
    return q.withColumn("t", (F.row_number().over(w) - 1).cast("int")).orderBy("t")


SUMS = ("n", "st", "stt", "sy", "sty", "syy")


def _line_sums(t: Column, y: Column, scale: int) -> list[Column]:
    """Exact sums of the least-squares normal equations (aggregate expressions, in ``SUMS`` order)."""
    yd = y.cast(f"decimal(38,{scale})")   # y carries ``scale`` decimals (cents)
    tl = t.cast("long")
    keep = y.isNotNull()
    return [F.count(F.when(keep, 1)), F.sum(F.when(keep, tl)), F.sum(F.when(keep, tl * tl)), F.sum(yd),
            F.sum(tl.cast("decimal(38,0)") * yd), F.sum(yd * yd)]


def _line(n, st, stt, sy, sty, syy) -> dict[str, Column]:
    """Closed form: slope, intercept and R² from the exact sums."""
    den = (n * stt - st * st).cast("double")
    num = (n * sty - st * sy).cast("double")
    var_y = (n * syy - sy * sy).cast("double")
    pente = F.when(den != 0, num / den)
    return {"pente": pente,
            "ordonnee": (sy.cast("double") - pente * st.cast("double")) / n,
            "r2": F.when((den != 0) & (var_y != 0), (num * num) / (den * var_y))}


def fit_line(series: DataFrame, x: str = "t", y: str = "ca_total", scale: int = 2) -> DataFrame:
    """One row ``(pente, ordonnee, r2, n)``: least-squares line of y on x, and R².

    Closed form over exact sums (x integer, y in DECIMAL): the sums do not depend on the
    order rows are added in, so the line is the same whatever the partitioning, and the
    few double operations that follow are the same in any SQL engine.
    """
    s = series.agg(*[c.alias(name) for c, name in zip(_line_sums(F.col(x), F.col(y), scale), SUMS)])
    line = _line(*[F.col(c) for c in SUMS])
    return s.select(line["pente"].alias("pente"), line["ordonnee"].alias("ordonnee"), line["r2"].alias("r2"),
                    F.col("n"))


def forecast_model(fact: DataFrame, dim_temps: DataFrame) -> DataFrame:
    return fit_line(trend_index(fact, dim_temps))


def _next_quarter(annee, trimestre, steps):
    idx = F.col(annee) * 4 + (F.col(trimestre) - 1) + steps
    return F.floor(idx / 4).cast("int"), (idx % 4 + 1).cast("int")


def forecast_series(fact: DataFrame, dim_temps: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Actual, fitted and forecast revenue in one series.

    Columns: ``t, annee, trimestre, periode, ca_total, ca_prevu, type``; ``type`` is
    ``reel`` for quarters present and ``prevision`` for the ``horizon`` quarters that follow
    the last one present (labels follow the data; the source hard-codes two labels).
    The series has one row per quarter (bounded by the calendar): the line's sums are
    window aggregates over it, and the future rows are generated from its last row.
    """
    series = trend_index(fact, dim_temps)
    every = Window.partitionBy()
    sums = [agg.over(every) for agg in _line_sums(F.col("t"), F.col("ca_total"), 2)]
    line = _line(*sums)
    s = series.select("t", "annee", "trimestre", "periode", "ca_total",
                      line["pente"].alias("_pente"), line["ordonnee"].alias("_ordonnee"),
                      F.max("t").over(every).alias("_t_last"))
    actual = s.select("t", "annee", "trimestre", "periode", "ca_total",
                      (F.col("_ordonnee") + F.col("_pente") * F.col("t")).alias("ca_prevu"),
                      F.lit("reel").alias("type"))
    last = s.filter(F.col("t") == F.col("_t_last")).withColumn(
        "_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    yr, qt = _next_quarter("annee", "trimestre", F.col("_step"))
    future = (last.select((F.col("t") + F.col("_step")).cast("int").alias("t"), yr.alias("annee"),
                          qt.alias("trimestre"), F.lit(None).cast("double").alias("ca_total"),
                          (F.col("_ordonnee") + F.col("_pente") * (F.col("t") + F.col("_step"))).alias("ca_prevu"),
                          F.lit("prevision").alias("type"))
              .withColumn("periode", kpis.periode_trimestre()).select(*actual.columns))
    return actual.unionByName(future).orderBy("t")
