"""Folds, scaling, trees, regimes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.operators import ml
from tickflow.plans import features as pf
from tickflow.plans.rowindex import row_index
from tickflow.schemas import FEATURES, TARGET
from tickflow.session import cut_lineage

from . import tables as t
from .registry import query, rounded

ORDER = ["window_start", "symbol"]
REGIME_FEATURES = ["rolling_vol", "price_range_ratio", "vol_ratio"]


def features(spark, sf):
    """Training reads the features many times, so they are written first."""
    return pf.training_rows(cut_lineage(pf.feature_table(t.bars(spark, sf), t.slots(spark, sf), t.BAR, t.SLOT,
                                                         chunk_rows=t.CHUNK_ROWS)))


@query("ts_folds", "features", """
    , n AS (SELECT symbol, window_start, row_number() OVER (ORDER BY window_start, symbol) - 1 AS row_index FROM features),
    c AS (SELECT count(*) AS rows, count(*) // 6 AS size FROM features)
    SELECT symbol, window_start, row_index,
           CAST(CASE WHEN row_index < rows - 5 * size THEN 0 ELSE (row_index - (rows - 5 * size)) // size + 1 END AS INTEGER)
           AS fold FROM n, c""")
def ts_folds(spark, sf):
    return ml.time_folds(features(spark, sf).select("symbol", "window_start"), ORDER)


@query("standardize", "features", "SELECT symbol, window_start, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in FEATURES) + " FROM features")
def standardize(spark, sf):
    f = features(spark, sf).select("symbol", "window_start", *FEATURES)
    return rounded(ml.standardize(f, FEATURES), *FEATURES)


@query("training_rows", "features", "SELECT symbol, window_start, " + ", ".join(
    f"round(coalesce({c}, 0), 6) AS {c}" for c in [*FEATURES, TARGET]) + " FROM features")
def training_rows(spark, sf):
    return rounded(features(spark, sf), *FEATURES, TARGET)


# What a model learns is not for SQL to say; these queries return what must hold of it, row by row.

@query("gbt_scores", "features", f"""
    , n AS (SELECT symbol, window_start, {TARGET}, row_number() OVER (ORDER BY window_start, symbol) - 1 AS i FROM features),
    c AS (SELECT CAST(floor(count(*) * CAST({ml.TRAIN_SHARE} AS DOUBLE)) AS BIGINT) AS cut FROM features)
    SELECT symbol, window_start, round(coalesce({TARGET}, 0), 6) AS {TARGET}, i < cut AS trained_on, 'v1' AS model_version, TRUE AS scored
    FROM n, c""")
def gbt_scores(spark, sf):
    indexed = row_index(features(spark, sf), ORDER)
    train, tail = ml.split_tail(indexed)
    model = ml.train_gbt(train, tail)
    scored = F.col("predicted_vol").isNotNull() & ~F.isnan("predicted_vol")
    cut = indexed.count() * ml.TRAIN_SHARE
    out = ml.score(model, indexed, "v1").select("symbol", "window_start", TARGET, (F.col("row_index") < int(cut)).alias("trained_on"),
                                                "model_version", scored.alias("scored"))
    return rounded(out, TARGET)


@query("gbt_patience", sql="SELECT TRUE AS best_kept, TRUE AS patient FROM (SELECT count(*) FROM events)")
def gbt_patience(spark, sf):
    """Boosting with patience: the model kept has the least loss on the validation rows of all rounds up to ``PATIENCE`` after it, and as many trees."""
    train, tail = ml.split_tail(row_index(features(spark, sf), ORDER))
    train, tail = cut_lineage(train), cut_lineage(tail)
    model, losses = ml.train_patient(train, tail)
    trees = model.stages[-1].getNumTrees
    least = min(range(min(len(losses), trees + ml.PATIENCE)), key=losses.__getitem__)
    error = F.col("predicted_vol") - F.col(TARGET)
    loss = F.avg(error * error)
    waited = len(losses) - trees >= ml.PATIENCE or len(losses) == ml.TREES["maxIter"]
    return model.transform(tail).agg((F.abs(loss - F.lit(losses[least])) <= 1e-9 * F.abs(loss)).alias("best_kept"),
                                     F.lit(trees == least + 1 and waited).alias("patient"))


@query("gbt_cv", "features", """
    SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold, count(*) // 6 AS n, TRUE AS sound FROM features""")
def gbt_cv(spark, sf):
    """Per fold: rows, and whether the errors can be errors (a mean is never above a root mean square)."""
    per_fold = ml.cross_validate(ml.time_folds(features(spark, sf), ORDER))
    return per_fold.select("fold", "n", ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-12)).alias("sound"))


@query("gbt_cv_summary", "features", "SELECT 5 AS folds, TRUE AS sound FROM (SELECT count(*) FROM features)")
def gbt_cv_summary(spark, sf):
    """Mean and deviation over the folds, as promotion takes them."""
    per_fold = ml.cross_validate(ml.time_folds(features(spark, sf), ORDER))
    return ml.cv_summary(per_fold).select(F.lit(ml.FOLDS).alias("folds"), (
        (F.col("mae_cv_mean") > 0) & (F.col("mae_cv_std") >= 0) & (F.col("rmse_cv_mean") >= F.col("mae_cv_mean"))).alias("sound"))


@query("gbt_importances", "features", "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + """]) AS feature,
    TRUE AS in_range, 1.0::DOUBLE AS total FROM (SELECT count(*) FROM features)""")
def gbt_importances(spark, sf):
    train, tail = ml.split_tail(row_index(features(spark, sf), ORDER))
    shares = ml.importances(ml.train_gbt(train, tail))
    total = round(sum(v for _, v in shares), 6)
    return spark.createDataFrame([(f, 0 <= v <= 1, total) for f, v in shares], "feature string, in_range boolean, total double")


def _sizes(sweep):
    """Every row is in one cluster and no cluster is empty."""
    return sweep.select("k", "seed", F.aggregate("cluster_sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"),
                        F.forall("cluster_sizes", lambda x: x > 0).alias("none_empty"),
                        F.col("silhouette").between(-1, 1).alias("in_range"))


def _sizes_sql(ks, seeds):
    return (f"SELECT CAST(k AS INTEGER) AS k, CAST(seed AS INTEGER) AS seed, n, TRUE AS none_empty, TRUE AS in_range FROM "
            f"(SELECT count(*) AS n FROM features), (SELECT unnest({list(ks)}) AS k), (SELECT unnest({list(seeds)}) AS seed)")


@query("kmeans_sweep", "features", _sizes_sql(ml.CLUSTER_RANGE, [42]))
def kmeans_sweep(spark, sf):
    return _sizes(ml.kmeans_sweep(features(spark, sf), REGIME_FEATURES))


@query("kmeans_stability", "features", _sizes_sql([ml.PREFERRED_K], ml.CLUSTER_SEEDS))
def kmeans_stability(spark, sf):
    return _sizes(ml.kmeans_sweep(features(spark, sf), REGIME_FEATURES, ks=[ml.PREFERRED_K], seeds=ml.CLUSTER_SEEDS))


@query("pca2", "features", "SELECT symbol, window_start, TRUE AS placed FROM features")
def pca2(spark, sf):
    placed = ml.pca2(features(spark, sf), REGIME_FEATURES, keep=ORDER)[0]
    return placed.select("symbol", "window_start", (F.col("pc1").isNotNull() & F.col("pc2").isNotNull()).alias("placed"))


@query("pca_loadings", "features", "SELECT unnest([" + ", ".join(f"'{c}'" for c in REGIME_FEATURES) + """]) AS feature,
    1.0::DOUBLE AS length1, 1.0::DOUBLE AS length2, 0.0::DOUBLE AS product, TRUE AS in_order FROM (SELECT count(*) FROM features)""")
def pca_loadings(spark, sf):
    """Loadings are unit vectors at right angles, and the first explains more."""
    loads = ml.pca2(features(spark, sf), REGIME_FEATURES)[1]
    whole = loads.agg(F.round(F.sqrt(F.sum(F.col("pc1") ** 2)), 6).alias("length1"), F.round(F.sqrt(F.sum(F.col("pc2") ** 2)), 6).alias("length2"),
                      F.abs(F.round(F.sum(F.col("pc1") * F.col("pc2")), 6)).alias("product"))
    return loads.join(F.broadcast(whole)).select("feature", "length1", "length2", "product", (      # one row
        (F.col("pc1_share") >= F.col("pc2_share")) & (F.col("pc1_share") + F.col("pc2_share") <= 1 + 1e-9)).alias("in_order"))


@query("kmeans_regimes", "features", """
    SELECT f.symbol, f.window_start, round(b.close, 6) AS close, TRUE AS named FROM features f JOIN bars b USING (symbol, window_start)""")
def kmeans_regimes(spark, sf):
    """Regimes found by clustering, named and laid along the closing price."""
    assigned = ml.assign_clusters(features(spark, sf), REGIME_FEATURES, ml.PREFERRED_K)
    labels = ml.regime_labels(assigned, REGIME_FEATURES, ml.PREFERRED_K)
    out = ml.regime_timeline(assigned, labels, t.bars(spark, sf))
    return rounded(out.select("symbol", "window_start", "close", F.col("label").isin(ml.REGIME_NAMES[ml.PREFERRED_K]).alias("named")), "close")


def _given(spark, sf):
    """Assignments that SQL can state too."""
    return t.features(spark, sf).where("rolling_vol IS NOT NULL").withColumn(
        "cluster_id", (F.col("trade_count") % 3).cast("int"))


REGIMES = """
    , a AS (SELECT *, CAST(trade_count % 3 AS INTEGER) AS cluster_id FROM feats WHERE rolling_vol IS NOT NULL),
    c AS (SELECT cluster_id, count(*) AS n, avg(rolling_vol) AS rolling_vol, avg(price_range_ratio) AS price_range_ratio,
                 avg(vol_ratio) AS vol_ratio FROM a GROUP BY 1),
    o AS (SELECT avg(rolling_vol) AS m1, stddev_samp(rolling_vol) AS s1, avg(price_range_ratio) AS m2,
                 stddev_samp(price_range_ratio) AS s2, avg(vol_ratio) AS m3, stddev_samp(vol_ratio) AS s3 FROM a),
    l AS (SELECT *, CAST(row_number() OVER (ORDER BY rolling_vol, cluster_id) - 1 AS INTEGER) AS rank FROM c),
    g AS (SELECT cluster_id, n, rank, CASE rank WHEN 0 THEN 'Stabil' WHEN 1 THEN 'Volatilitas Sedang'
                 ELSE 'Volatilitas Tinggi' END AS label,
                 round(rolling_vol, 6) AS rolling_vol, round(price_range_ratio, 6) AS price_range_ratio,
                 round(vol_ratio, 6) AS vol_ratio, round((rolling_vol - m1) / s1, 6) AS z_rolling_vol,
                 round((price_range_ratio - m2) / s2, 6) AS z_price_range_ratio, round((vol_ratio - m3) / s3, 6) AS z_vol_ratio
          FROM l, o)"""


@query("regime_labels", "feats", REGIMES + " SELECT * FROM g")
def regime_labels(spark, sf):
    out = ml.regime_labels(_given(spark, sf), REGIME_FEATURES, 3).withColumnsRenamed(
        {f"mean_{c}": c for c in REGIME_FEATURES})
    return rounded(out, *REGIME_FEATURES, *[f"z_{c}" for c in REGIME_FEATURES])


@query("regime_timeline", "feats", REGIMES + """
    SELECT a.symbol, a.window_start, a.cluster_id, g.label, a.close FROM a JOIN g USING (cluster_id)""")
def regime_timeline(spark, sf):
    assigned = _given(spark, sf)
    return ml.regime_timeline(assigned, ml.regime_labels(assigned, REGIME_FEATURES, 3), t.bars(spark, sf))
