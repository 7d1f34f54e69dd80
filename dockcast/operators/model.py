"""Ridge forecast of the fill level: fit, predict, forecast rows, R²,
recursive (multi-step) forecast, time split, model persistence.

The fit is one aggregation pass: centred cross-products (``covar_pop``,
numerically stable and partially aggregated) give the normal equations of a
ridge with an unpenalised intercept; the k×k solve is the model, not data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.scalar import clip01, col, reconstruct_fill
from dockcast.operators import sequence as sq


@dataclass
class RidgeModel:
    features: list[str]
    coef: list[float]
    intercept: float

    def prediction(self) -> Column:
        """Prediction as a pure column expression (stays in codegen)."""
        out = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coef):
            out = out + F.lit(float(w)) * col(f).cast("double")
        return out

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(f, float(w)) for f, w in zip(self.features, self.coef)] + [("__intercept__", float(self.intercept))],
            "feature string, weight double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RidgeModel":
        rows = {r.feature: r.weight for r in spark.read.parquet(path).collect()}
        b = rows.pop("__intercept__")
        return RidgeModel(list(rows), list(rows.values()), b)


@dataclass
class ModelStore:
    """Models by name and version in a shared folder (``base/<name>/v=<n>``). A
    version gets its name once its table is complete and never changes; all
    names and versions are listed from the folder."""
    spark: SparkSession
    base: str

    def versions(self, name: str) -> list[int]:
        from dockcast.sources import files
        return [files.number(f) for f in files.folders(self.spark, f"{self.base}/{name}", "v")]

    def names(self) -> list[str]:
        from dockcast.sources import files
        return sorted(n for n in files.children(self.spark, self.base) if self.versions(n))

    def save(self, name: str, model: RidgeModel) -> int:
        """Store a model as the next version; returns its number."""
        import uuid

        from dockcast.sources import files
        version = max(self.versions(name), default=0) + 1
        draft = f"{self.base}/{name}/_draft-{uuid.uuid4().hex}"
        model.save(self.spark, draft)
        files.publish(self.spark, draft, f"{self.base}/{name}/v={version}")
        return version

    def load(self, name: str, version: int | None = None) -> RidgeModel:
        """A version of a model, the newest unless it is named."""
        there = self.versions(name)
        wanted = version if version is not None else max(there, default=None)
        if wanted not in there:
            raise LookupError(f"no model {name!r}" + (f" in version {version}" if version is not None else "") + f"; versions: {there}")
        return RidgeModel.load(self.spark, f"{self.base}/{name}/v={wanted}")


def _moment_exprs(features: Sequence[str], target: str) -> list[Column]:
    xs = [col(f).cast("double") for f in features]
    y = col(target).cast("double")
    out = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my")]
    out += [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    for i in range(len(xs)):
        out.append(F.covar_pop(xs[i], y).alias(f"cy{i}"))
        for j in range(i, len(xs)):
            out.append(F.covar_pop(xs[i], xs[j]).alias(f"c{i}_{j}"))
    return out


def _complete(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return df.dropna(subset=[*features, target])


def ridge_moments(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row of sufficient statistics (rows with a null input dropped)."""
    return _complete(df, features, target).agg(*_moment_exprs(features, target))


def _solve(row, k: int, alpha: float) -> tuple[list[float], float]:
    n = float(row["n"])
    sxx = np.zeros((k, k))
    sxy = np.zeros(k)
    for i in range(k):
        sxy[i] = row[f"cy{i}"] * n
        for j in range(i, k):
            sxx[i, j] = sxx[j, i] = row[f"c{i}_{j}"] * n
    w = np.linalg.solve(sxx + alpha * np.eye(k), sxy)
    b = row["my"] - float(sum(w[i] * row[f"m{i}"] for i in range(k)))
    return [float(v) for v in w], float(b)


def ridge_fit(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> RidgeModel:
    """Ridge regression with intercept (intercept not penalised), alpha on
    the sum-of-squares scale: minimise Σ(y − b − x·w)² + alpha·|w|²."""
    return ridge_fit_counted(df, features, target, alpha)[0]


def ridge_fit_counted(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> tuple[RidgeModel, int]:
    """The model and how many rows it was fitted on, in one pass."""
    row = ridge_moments(df, features, target).first()
    w, b = _solve(row, len(features), alpha)
    return RidgeModel(list(features), w, b), int(row["n"])


def ridge_fit_1d_df(df: DataFrame, feature: str, target: str, alpha: float = 1.0,
                    w_name: str = "w", b_name: str = "b") -> DataFrame:
    """One-feature ridge entirely as a Spark aggregate (no driver step)."""
    m = ridge_moments(df, [feature], target)
    w = (F.col("cy0") * F.col("n")) / (F.col("c0_0") * F.col("n") + F.lit(alpha))
    return m.select(w.alias(w_name), (F.col("my") - w * F.col("m0")).alias(b_name))


def ridge_fit_ml(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0):
    """The same fit with Spark ML (L-BFGS). Spark scales the L2 term by
    1/n and by the label's std, so regParam = alpha·std(y)/n reproduces
    the sum-of-squares ridge."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    d = _complete(df, features, target)
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(col(target)).alias("sy")).first()
    reg = alpha * float(stats["sy"]) / float(stats["n"])
    va = VectorAssembler(inputCols=list(features), outputCol="_features")
    lr = LinearRegression(featuresCol="_features", labelCol=target, solver="l-bfgs", elasticNetParam=0.0,
                          regParam=reg, standardization=False, fitIntercept=True, tol=1e-12, maxIter=500)
    m = lr.fit(va.transform(d))
    return RidgeModel(list(features), [float(v) for v in m.coefficients], float(m.intercept))


def ridge_fit_per_key(df: DataFrame, key: Sequence[str] | str, features: Sequence[str], target: str,
                      alpha: float = 1.0) -> DataFrame:
    """One ridge per station: per-key moments (a partial aggregate, so a hot
    station is combined map-side), then a k×k solve per key on the small
    moments table (one row per key)."""
    from dockcast.session import ship_package
    ship_package(df.sparkSession)
    key = [key] if isinstance(key, str) else list(key)
    k = len(features)
    mom = _complete(df, features, target).groupBy(*key).agg(*_moment_exprs(features, target))
    key_schema = ", ".join(f"{c} {mom.schema[c].dataType.simpleString()}" for c in key)
    out_schema = f"{key_schema}, intercept double, " + ", ".join(f"w_{f} double" for f in features)

    def solve(pdf):
        n = pdf["n"].to_numpy("float64")
        sxx, sxy = np.zeros((len(pdf), k, k)), np.zeros((len(pdf), k))
        for i in range(k):
            sxy[:, i] = pdf[f"cy{i}"].to_numpy("float64") * n
            for j in range(i, k):
                sxx[:, i, j] = sxx[:, j, i] = pdf[f"c{i}_{j}"].to_numpy("float64") * n
        # one batched solve; alpha > 0 makes every system regular, else a singular one gives nan
        a = sxx + alpha * np.eye(k)
        bad = ~(np.isfinite(a).all((1, 2)) & (np.linalg.matrix_rank(np.nan_to_num(a)) == k)) if len(pdf) else np.zeros(0, bool)
        a[bad], sxy[bad] = np.eye(k), np.nan
        w = np.linalg.solve(a, sxy[:, :, None])[:, :, 0]
        out = pdf[key].copy()
        out["intercept"] = pdf["my"].to_numpy("float64") - sum(w[:, i] * pdf[f"m{i}"].to_numpy("float64") for i in range(k))
        for i, f in enumerate(features):
            out[f"w_{f}"] = w[:, i]
        return out
    return mom.mapInPandas(lambda it: (solve(p) for p in it), schema=out_schema)


def predict(df: DataFrame, model: RidgeModel, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, model.prediction())


def forecast_fill(df: DataFrame, model: RidgeModel, pct: str = "pct_full", out: str = "fill_rate",
                  mode: str = "serving") -> DataFrame:
    """Predicted change → fill level, clipped to [0, 1]."""
    return df.withColumn(out, clip01(reconstruct_fill(col(pct), model.prediction(), mode)))


def forecast_rows(df: DataFrame, model: RidgeModel, *, station: str = "station_id", base_ts: str = "extraction_ts",
                  pct: str = "pct_full", run_ts=None, horizon_minutes: int = 30, mode: str = "serving") -> DataFrame:
    """Long forecast rows: horizon 0 = the observed fill, horizon 1 = the
    prediction, each with base_ts, forecast time and run_ts. One pass:
    ``inline`` of a two-element array instead of a union of two scans."""
    from dockcast.functions.scalar import forecast_ts
    pred = clip01(reconstruct_fill(col(pct), model.prediction(), mode))
    run = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.col(base_ts).cast("timestamp")
    rows = F.array(
        F.struct(F.lit(0).alias("relative_ts"), col(pct).cast("double").alias("fill_rate"), col(base_ts).alias("ts")),
        F.struct(F.lit(1).alias("relative_ts"), pred.alias("fill_rate"),
                 forecast_ts(base_ts, horizon_minutes, ntz=False).cast(df.schema[base_ts].dataType).alias("ts")))
    return df.select(F.col(station).alias("station_id"), F.col(base_ts).alias("base_ts"),
                     run.alias("run_ts"), F.inline(rows))


def r2_score(df: DataFrame, truth: str | Column, prediction: str | Column, out: str = "r2",
             swap: bool = False) -> DataFrame:
    """Coefficient of determination 1 − SS_res / SS_tot around the mean of
    the truth. ``swap=True`` reproduces calling it as (prediction, truth).
    With a constant truth it is 1 for a perfect prediction, else 0."""
    y, p = (col(prediction), col(truth)) if swap else (col(truth), col(prediction))
    d = df.select(y.cast("double").alias("_y"), p.cast("double").alias("_p")).dropna()
    s = d.agg(F.sum(F.pow(F.col("_y") - F.col("_p"), 2)).alias("res"), (F.var_pop("_y") * F.count(F.lit(1))).alias("tot"))
    r2 = F.when(F.col("tot") > 0, F.lit(1.0) - F.try_divide("res", "tot")).otherwise(F.when(F.col("res") == 0, 1.0).otherwise(F.when(F.col("res") > 0, 0.0)))
    return s.select(r2.alias(out))


def time_split(df: DataFrame, ts: str, split, inclusive: str = "left") -> tuple[DataFrame, DataFrame]:
    """train = ts ≤ split, test = ts > split; ``inclusive='both'`` puts the
    boundary rows in both halves as the notebook did."""
    s = F.lit(split).cast(df.schema[ts].dataType)
    train = df.filter(F.col(ts) <= s)
    test = df.filter(F.col(ts) >= s) if inclusive == "both" else df.filter(F.col(ts) > s)
    return train, test


def split_xy(df: DataFrame, target: str, index: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(features, target): every column but the target, and the target alone;
    ``index`` columns stay on both sides."""
    return df.drop(target), df.select(*index, col(target))


def split_label(ts: str | Column, split, train: str = "train", test: str = "test") -> Column:
    return F.when(col(ts) <= F.lit(split), F.lit(train)).otherwise(F.lit(test))


def recursive_forecast(df: DataFrame, key, order, *, step_slope: Column, step_offset,
                       first_value: Column, floor: float | None = 0.0, out: str = "forecast",
                       cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Multi-step forecast that feeds its own output back, per station in
    time order: p_1 = max(floor, first_value), p_n = max(floor, slope_n·p_{n-1}
    + offset_n); ``step_offset`` may be a list of terms, added in order. A linear model whose features include the previous fill is
    exactly such a step (slope = 1 + weight of the fill, offset = the rest).

    Runs as a parallel scan (``sequence.clamped_affine_scan``): only each
    chunk of one station is sequential.
    """
    lo = float("-inf") if floor is None else float(floor)
    terms = list(step_offset) if isinstance(step_offset, (list, tuple)) else [step_offset]
    rest = None
    for t in terms[1:]:
        rest = t if rest is None else rest + t
    return sq.clamped_affine_scan(df, key, order, a=step_slope, b=terms[0], c=rest,
                                  a_first=F.lit(0.0), b_first=first_value, lo=lo, out=out, cfg=cfg)

