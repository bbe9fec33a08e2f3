"""Volatility models: time-ordered folds, gradient-boosted trees, regimes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import one_row
from ..plans.rowindex import row_index
from ..schemas import FEATURES, TARGET

# How the model is trained.
TREES = dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=5, seed=42)
FEATURE_SHARE = "0.8"
FOLDS = 5
TRAIN_SHARE = 0.9
#: Improvement on the validation rows below which boosting stops.
STOP_BELOW = 1e-4
#: Fixed value: rounds without a better validation loss after which boosting stops.
PATIENCE = 20

# K-means sweep.
CLUSTER_RANGE = range(2, 10)
CLUSTER_SEEDS = (0, 42, 123, 999)
PREFERRED_K = 3
#: Starts per K and seed, of which the best counts.
STARTS = 10
#: Rounds at most, the move below which centres are settled, and the rows that first centres are drawn from.
ROUNDS, SETTLED, INIT_ROWS = 20, 1e-4, 10_000

# Names of regimes by rank of mean volatility.
REGIME_NAMES = {
    2: ["Volatilitas Rendah", "Volatilitas Tinggi"],
    3: ["Stabil", "Volatilitas Sedang", "Volatilitas Tinggi"],
    4: ["Stabil", "Volatilitas Rendah", "Volatilitas Sedang", "Volatilitas Tinggi"],
}


def standardize(df: DataFrame, columns: Sequence[str], by_stats_of: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0.

    The statistics are one row, from ``by_stats_of`` when given (training rows).
    """
    source = by_stats_of if by_stats_of is not None else df
    stats = source.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns],
                       *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    of = one_row(stats)
    scale = lambda c: F.when(of[f"_s_{c}"] == 0, F.lit(1.0)).otherwise(of[f"_s_{c}"])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, *[((F.col(c) - of[f"_m_{c}"]) / scale(c)).alias(c) for c in columns])


def fold_bounds(n_rows: int, folds: int = FOLDS) -> list[tuple[int, int, int]]:
    """(fold, first validation row, end): the tail is cut into equal blocks and each
    fold trains on everything before its block."""
    size = n_rows // (folds + 1)
    if size == 0:
        raise ValueError(f"{n_rows} rows are too few for {folds} folds")
    first = n_rows - folds * size
    return [(i + 1, first + i * size, first + (i + 1) * size) for i in range(folds)]


def time_folds(df: DataFrame, order: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """Add ``row_index`` and ``fold``: the fold a row validates in, 0 for the rows only trained on."""
    indexed = row_index(df, order)
    n = indexed.count()
    bounds = fold_bounds(n, folds)
    first, size = bounds[0][1], bounds[0][2] - bounds[0][1]
    at = F.col("row_index")
    return indexed.withColumn("fold", F.when(at < first, F.lit(0)).otherwise(
        (F.floor((at - first) / size) + 1).cast("int")))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def train_gbt(train: DataFrame, valid: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
              **overrides):
    """Boosted trees with early stopping on ``valid``; returns a fitted pipeline.

    Trees do not depend on the scale of their inputs, so none is applied here.
    """
    params = {**TREES, **overrides}
    rows = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol="predicted_vol",
                       featureSubsetStrategy=FEATURE_SHARE, validationIndicatorCol="_valid",
                       validationTol=STOP_BELOW, **params)
    return Pipeline(stages=[_assembler(features), gbt]).fit(rows)


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(round of least loss, counted from 1, before ``patience`` rounds pass without a better one; whether they have passed)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def train_patient(train: DataFrame, valid: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
                  patience: int = PATIENCE, first: int = 2 * PATIENCE, **overrides):
    """Boosted trees that stop once ``patience`` rounds brought no better loss on ``valid``, cut back to the best round.

    Returns the fitted pipeline and the losses. Rounds are trained ``first`` at a time, then twice as many, until the losses
    say stop; a round depends on those before alone, so the model of the best round is trained as one of that many rounds.
    """
    params = {**TREES, **overrides}
    most = params.pop("maxIter")

    def fitted(rounds: int):
        gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol="predicted_vol", featureSubsetStrategy=FEATURE_SHARE,
                           maxIter=rounds, **params)
        return Pipeline(stages=[_assembler(features), gbt]).fit(train)

    rounds = min(first, most)
    while True:
        model = fitted(rounds)
        losses = list(model.stages[-1].evaluateEachIteration(model.stages[0].transform(valid), "squared"))
        chosen, stopped = best_round(losses, patience)
        if stopped or rounds >= most:
            return (model if chosen == rounds else fitted(chosen)), losses
        rounds = min(2 * rounds, most)


def split_tail(indexed: DataFrame, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(first ``share`` of the rows in order, the rest)."""
    cut = int(indexed.count() * share)
    return indexed.where(F.col("row_index") < cut), indexed.where(F.col("row_index") >= cut)


def score(model, rows: DataFrame | None, version: str, features: Sequence[str] = FEATURES) -> DataFrame | None:
    """Predictions for rows whose features are all known, as the model gives them (rejecting
    negative ones is up to ``schemas.prediction_rules``). Without a model nothing is scored."""
    if model is None or rows is None:
        return None
    ready = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in features]))
    return model.transform(ready).withColumn("model_version", F.lit(version)).drop("features")


class LinearModel:
    """A model of fixed weights, in built-in expressions."""

    def __init__(self, weights: dict[str, float], intercept: float = 0.0):
        self.weights, self.intercept = dict(weights), float(intercept)

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("predicted_vol", reduce(lambda a, b: a + b, [
            F.col(c) * F.lit(float(w)) for c, w in self.weights.items()], F.lit(self.intercept)))


def cross_validate(folded: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
                   **overrides) -> DataFrame:
    """MAE and RMSE of each fold, trained on the rows before it. One model at a time;
    each is fitted by Spark over all executors."""
    n_folds = folded.agg(F.max("fold")).first()[0]
    parts = []
    for k in range(1, n_folds + 1):
        train, valid = folded.where(F.col("fold") < k), folded.where(F.col("fold") == k)
        model = train_gbt(train, valid, features, target, **overrides)
        error = F.col("predicted_vol") - F.col(target)
        parts.append(model.transform(valid).agg(
            F.lit(k).alias("fold"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
            F.count(F.lit(1)).alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("mae").alias("mae_cv_mean"), F.stddev_pop("mae").alias("mae_cv_std"),
                        F.avg("rmse").alias("rmse_cv_mean"))


def importances(model, features: Sequence[str] = FEATURES) -> list[tuple[str, float]]:
    return list(zip(features, [float(v) for v in model.stages[-1].featureImportances.toArray()]))


@dataclass
class Centres:
    """One run of K-means: its centres, inertia and the sizes of its clusters."""
    k: int
    seed: int
    points: np.ndarray
    inertia: float = float("inf")
    sizes: np.ndarray | None = None
    moving: bool = True


def _first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """K-means++: each next centre drawn with a chance that grows with the squared distance to those before."""
    rng = np.random.default_rng(seed)
    points = [sample[rng.integers(len(sample))]]
    while len(points) < k:
        gap = ((sample[:, None, :] - np.array(points)[None]) ** 2).sum(axis=2).min(axis=1)
        total = gap.sum()
        points.append(sample[rng.choice(len(sample), p=gap / total) if total > 0 else rng.integers(len(sample))])
    return np.array(points)


def _assigned(rows: DataFrame, columns: Sequence[str], runs: list[Centres]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(sums, counts, inertia) of every run's clusters from one scan of ``rows``: a task sends one row per
    cluster of every run, and these are added up."""
    points = np.concatenate([r.points for r in runs])
    ends = np.cumsum([r.k for r in runs])
    width = len(columns)

    def partial(batches):
        total = np.zeros((len(points), width + 2))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            for at in range(0, len(x), 4096):
                part = x[at:at + 4096]
                gaps = ((part * part).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * part @ points.T).clip(min=0)
                for first, end in zip(np.r_[0, ends[:-1]], ends):
                    nearest = gaps[:, first:end].argmin(axis=1)
                    for c in range(end - first):
                        mine = nearest == c
                        total[first + c] += [*part[mine].sum(axis=0), mine.sum(), gaps[mine, first + c].sum()]
        used = np.flatnonzero(total[:, width])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(total[used, i].copy()) for i in range(width + 2)]],
                                         names=["c", *[f"s{i}" for i in range(width + 2)]])

    names = [f"s{i}" for i in range(width + 2)]
    sums = rows.select(*columns).mapInArrow(partial, "c int, " + ", ".join(f"{n} double" for n in names)).groupBy("c").agg(
        *[F.sum(n).alias(n) for n in names])
    whole = np.zeros((len(points), width + 2))
    for r in sums.collect():        # a row per centre
        whole[r["c"]] = [r[n] for n in names]
    return [(whole[a:b, :width], whole[a:b, width], float(whole[a:b, width + 1].sum())) for a, b in zip(np.r_[0, ends[:-1]], ends)]


def shared_kmeans(rows: DataFrame, columns: Sequence[str], ks: Sequence[int], seeds: Sequence[int] = (42,), starts: int = STARTS,
                  rounds: int = ROUNDS, settled: float = SETTLED) -> dict[tuple[int, int], Centres]:
    """K-means for every K and seed, the best of ``starts`` runs each, all in the same scans.

    A round is one scan, in which every row meets the centres of all runs that still move; ``rounds`` bounds the scans,
    not the number of runs. First centres come from a sample of at most ``INIT_ROWS`` rows, chosen by hash; rounds see all rows.
    """
    kept = rows.select(*columns)
    chosen = kept.distinct().orderBy(F.xxhash64(*columns), *columns).limit(INIT_ROWS).toPandas().to_numpy(dtype=float)
    runs = []
    for k in ks:
        for seed in seeds:
            draw = Random(seed)
            runs += [Centres(k, seed, _first_centres(chosen, k, s)) for s in [seed, *[draw.getrandbits(31) for _ in range(starts - 1)]]]
    for turn in range(rounds + 1):
        moving = [r for r in runs if r.moving]
        if not moving:
            break
        for run, (sums, counts, inertia) in zip(moving, _assigned(kept, columns, moving)):
            run.inertia, run.sizes = inertia, counts
            after = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], run.points)
            if turn == rounds or ((after - run.points) ** 2).sum(axis=1).max() <= settled ** 2:
                run.moving = False
            else:
                run.points = after
    best: dict[tuple[int, int], Centres] = {}
    for run in runs:
        if (run.k, run.seed) not in best or run.inertia < best[run.k, run.seed].inertia:
            best[run.k, run.seed] = run
    return best


def nearest_centre(columns: Sequence[str], points: np.ndarray) -> Column:
    """Number of the nearest of a few centres; the first of equal ones."""
    gaps = [F.struct(reduce(lambda a, b: a + b, [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, p)]).alias("gap"),
                     F.lit(i).alias("i")) for i, p in enumerate(points)]
    return (F.least(*gaps) if len(gaps) > 1 else gaps[0])["i"]


def kmeans_sweep(df: DataFrame, features: Sequence[str], ks: Sequence[int] = CLUSTER_RANGE,
                 seeds: Sequence[int] = (42,), starts: int = STARTS) -> DataFrame:
    """Inertia, silhouette and cluster sizes per K (below the row count) and seed on standardized features,
    of the best of ``starts`` runs each."""
    rows = standardize(df.select(*features).dropna(), features)
    rows.persist()
    judge = ClusteringEvaluator(predictionCol="cluster")
    n = rows.count()
    found = shared_kmeans(rows, features, [k for k in ks if k < n], seeds, starts)
    vectors = _assembler(features).transform(rows)
    out = [(k, seed, run.inertia, float(judge.evaluate(vectors.withColumn("cluster", nearest_centre(features, run.points)))),
            [int(s) for s in run.sizes]) for (k, seed), run in found.items()]
    rows.unpersist()
    return df.sparkSession.createDataFrame(
        out, "k int, seed int, inertia double, silhouette double, cluster_sizes array<bigint>")


def choose_k(sweep: DataFrame, n_rows: int, preferred: int = PREFERRED_K) -> int:
    """The preferred K if there are rows enough, else the best silhouette."""
    if preferred < n_rows:
        return preferred
    return sweep.orderBy(F.desc("silhouette"), "k").first()["k"]


def assign_clusters(df: DataFrame, features: Sequence[str], k: int, seed: int = 42, starts: int = STARTS) -> DataFrame:
    """``df`` with ``cluster_id`` from the best of ``starts`` runs; rows with a missing feature are left out."""
    rows = df.dropna(subset=list(features))
    helper = [f"_z_{c}" for c in features]
    scaled = standardize(rows.select("*", *[F.col(c).alias(z) for c, z in zip(features, helper)]), helper)
    scaled.persist()
    run = shared_kmeans(scaled, helper, [k], [seed], starts)[k, seed]
    return scaled.withColumn("cluster_id", nearest_centre(helper, run.points)).drop(*helper)


def pca2(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pc1, pc2``; loadings and explained share per component)."""
    rows = _assembler(features).transform(standardize(df.select(*keep, *features).dropna(), features))
    model = PCA(k=2, inputCol="features", outputCol="pcs").fit(rows)
    arr = vector_to_array("pcs")
    projected = model.transform(rows).select(*keep, arr[0].alias("pc1"), arr[1].alias("pc2"))
    weights = model.pc.toArray()
    loadings = [(f, float(weights[i][0]), float(weights[i][1])) for i, f in enumerate(features)]
    share = [float(v) for v in model.explainedVariance]
    table = df.sparkSession.createDataFrame(loadings, "feature string, pc1 double, pc2 double")
    return projected, table.withColumn("pc1_share", F.lit(share[0])).withColumn("pc2_share", F.lit(share[1]))


def regime_labels(assigned: DataFrame, features: Sequence[str], k: int, vol: str = "rolling_vol") -> DataFrame:
    """Per cluster: size, mean of each feature, its z-score against all rows, rank of
    mean volatility and the regime's name. The result has ``k`` rows."""
    names = REGIME_NAMES.get(k, [f"Regime {i + 1}" for i in range(k)])
    centre = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"),
                                                *[F.avg(c).alias(f"mean_{c}") for c in features])
    overall = assigned.agg(*[F.avg(c).alias(f"_m_{c}") for c in features],
                           *[F.stddev_samp(c).alias(f"_s_{c}") for c in features])
    # k rows: rank by counting the centres below, no window needed
    order = centre.agg(F.array_sort(F.collect_list(F.struct(F.col(f"mean_{vol}").alias("v"), "cluster_id")))
                       .alias("_order"))
    of = one_row(overall)
    spread = lambda c: F.when(F.coalesce(of[f"_s_{c}"], F.lit(0.0)) == 0, F.lit(1.0)).otherwise(of[f"_s_{c}"])
    me = F.struct(F.col(f"mean_{vol}").alias("v"), "cluster_id")
    return (centre.withColumn("rank", F.array_position(order.scalar(), me).cast("int") - 1)
            .select("cluster_id", "n", "rank",
                    F.element_at(F.array(*[F.lit(n) for n in names]), F.col("rank") + 1).alias("label"),
                    *[F.col(f"mean_{c}") for c in features],
                    *[((F.col(f"mean_{c}") - of[f"_m_{c}"]) / spread(c)).alias(f"z_{c}") for c in features]))


def regime_timeline(assigned: DataFrame, labels: DataFrame, bars: DataFrame,
                    keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Regime and closing price of every bar that has one."""
    named = assigned.select(*keys, "window_start", "cluster_id").join(
        F.broadcast(labels.select("cluster_id", "label")), "cluster_id")   # one row per cluster
    return named.join(bars.select(*keys, "window_start", "close"), [*keys, "window_start"])
