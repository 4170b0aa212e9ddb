"""Baseline model: split, imputation, one-hot encoding, linear or logistic fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.config import AnalysisConfig
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators import profile as P
from tabulyst.operators import roles as R
from tabulyst.operators.selection import distinct_up_to, exact_quantiles
from tabulyst.session import stage

# Sizes of the baseline model.
TEST_SHARE = 0.2
MAX_LEVELS = 50
MAX_STRATA = 20
LOGISTIC_ITERATIONS = 300
MAX_CLASSES = 10_000

RESULT_SCHEMA = T.StructType([
    T.StructField("enabled", T.BooleanType()), T.StructField("target", T.StringType()),
    T.StructField("task_type", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("n_train", T.LongType()), T.StructField("n_test", T.LongType()),
    T.StructField("dropped_datetime_cols", T.ArrayType(T.StringType())),
    T.StructField("dropped_high_cardinality_cat_cols", T.ArrayType(T.StringType())),
    T.StructField("r2", T.DoubleType()), T.StructField("mae", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()), T.StructField("f1", T.DoubleType()),
    T.StructField("error", T.StringType()),
])


@dataclass(frozen=True)
class ModelMatrix:
    """The feature columns of a model, and those left out."""

    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    dropped_categorical: list[str] = field(default_factory=list)
    dropped_datetime: list[str] = field(default_factory=list)


def _texts(df: DataFrame, target: str) -> list[str]:
    return [
        f.name for f in df.schema
        if f.name != target and (S.is_text(f.dataType) or isinstance(f.dataType, T.BooleanType))
    ]


def model_matrix(
    df: DataFrame, target: str, max_levels: int = MAX_LEVELS, levels: dict | None = None
) -> ModelMatrix:
    """Choose the features; ``levels`` takes distinct counts that are known already."""
    features = [f for f in df.schema if f.name != target]
    texts = _texts(df, target)
    levels = distinct_up_to(df, texts, max_levels) if levels is None else levels
    return ModelMatrix(
        [f.name for f in features if S.is_numeric(f.dataType)],
        [c for c in texts if levels[c] is not None],
        [c for c in texts if levels[c] is None],
        [f.name for f in features if S.is_time(f.dataType)],
    )


def matrix_frame(df: DataFrame, target: str) -> DataFrame:
    m = model_matrix(df, target)
    rows = [(c, "numeric") for c in m.numeric] + [(c, "categorical") for c in m.categorical]
    rows += [(c, "dropped_high_cardinality") for c in m.dropped_categorical]
    rows += [(c, "dropped_datetime") for c in m.dropped_datetime]
    return df.sparkSession.createDataFrame(rows, "name string, part string")


def row_hash(df: DataFrame, seed: int) -> Column:
    """A repeatable 53-bit number per row, the same under any partitioning."""
    usable = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[col(c) for c in usable]), 11)


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """A digest of a row's key that other systems can recompute: md5 of the seed and the key's
    columns as texts, with bars between."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(c).cast("string") for c in keys]))


def split_by_key(df: DataFrame, keys: Sequence[str], seed: int = AnalysisConfig.random_seed) -> DataFrame:
    """Adds ``is_test``, true for the fifth of the rows whose key's digest begins lowest: rows
    with one key stay together, whatever else changes."""
    return df.withColumn("is_test", key_digest(keys, seed) < F.lit(f"{int(TEST_SHARE * 16**8):08x}"))


def sample_by_key(df: DataFrame, n: int, keys: Sequence[str], seed: int = AnalysisConfig.random_seed) -> DataFrame:
    """The n rows whose keys' digests are lowest: a random sample that can be recomputed."""
    return df.withColumn("__digest", key_digest(keys, seed)).orderBy("__digest", *[col(c) for c in keys]).limit(n).drop("__digest")


def split_rows(
    df: DataFrame, seed: int = AnalysisConfig.random_seed, stratify: str | None = None
) -> DataFrame:
    """Adds ``is_test``, true for a fifth of the rows.

    The plain split takes the rows whose hash falls in the lowest fifth of its
    range: no shuffle, no second look. The stratified one takes the lowest fifth
    of the hashes of each class, exactly, with the cut found by rank selection;
    no class is gathered in one place.
    """
    h = row_hash(df, seed)
    if stratify is None:
        return df.withColumn("is_test", h < F.lit(int(TEST_SHARE * 2**53)))
    hashed = df.select(col(stratify).alias("stratum"), h.alias("h"))
    cuts = exact_quantiles(hashed, {"h": F.col("h")}, [TEST_SHARE], ["stratum"])
    cut = F.lit(None).cast("double")
    for (key, _, _), value in cuts.values.items():
        same = col(stratify).eqNullSafe(F.lit(key[0]))
        cut = F.when(same, F.lit(value)).otherwise(cut)
    return df.withColumn("is_test", h.cast("double") <= cut)


def sample_rows(df: DataFrame, n: int, seed: int = AnalysisConfig.random_seed) -> DataFrame:
    """n rows chosen by hash: the same rows whatever the partitions, n at most in one task."""
    return df.withColumn("__hash", row_hash(df, seed)).orderBy("__hash").limit(n).drop("__hash")


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest of equals."""
    if not columns:
        return {}
    return {r["name"]: r["value"] for r in P.top_values(df, columns, 1, keep_missing=False).collect()}


def _prepared(df: DataFrame, m: ModelMatrix, train: DataFrame) -> DataFrame:
    """Features under plain names, gaps filled with what the training rows say."""
    fills = exact_quantiles(train, {c: col(c).cast("double") for c in m.numeric}, [0.5])
    common = modes(train, m.categorical)
    out = [
        F.coalesce(col(c).cast("double"), F.lit(fills.get(c, 0.5)), F.lit(0.0)).alias(f"x{i}")
        for i, c in enumerate(m.numeric)
    ]
    out += [
        F.coalesce(col(c).cast("string"), F.lit(common.get(c)), F.lit("")).alias(f"s{i}")
        for i, c in enumerate(m.categorical)
    ]
    return df.select("y", "is_test", *out)


def _encoder(m: ModelMatrix) -> list:
    text = [f"s{i}" for i in range(len(m.categorical))]
    numeric = [f"x{i}" for i in range(len(m.numeric))]
    stages: list = []
    if text:
        index = [f"{c}_index" for c in text]
        hot = [f"{c}_hot" for c in text]
        stages += [
            # the spare index for unseen values is the one dropped: they become all zero
            StringIndexer(inputCols=text, outputCols=index, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        numeric = numeric + hot
    return [*stages, VectorAssembler(inputCols=numeric, outputCol="features")]


@dataclass
class Fitted:
    """A fitted baseline: its record and the predictions on the test rows."""

    record: dict
    predictions: DataFrame | None = None

    def frame(self, spark) -> DataFrame:
        row = tuple(self.record.get(f.name) for f in RESULT_SCHEMA)
        return spark.createDataFrame([row], RESULT_SCHEMA)


def fit_baseline(
    df: DataFrame, target: str, cfg: AnalysisConfig = AnalysisConfig(), keys: Sequence[str] = ()
) -> Fitted:
    """Fit on four fifths, score on the rest; problems are recorded, not raised. With ``keys``
    these columns decide the split, and are no features."""
    if target not in df.columns:
        return Fitted({"enabled": False, "target": target, "error": f"target column not found: {target}"})
    try:
        return _fit(df, target, cfg, keys)
    except Exception as problem:  # the record carries the reason
        return Fitted({"enabled": False, "target": target, "error": repr(problem)})


def _fit(df: DataFrame, target: str, cfg: AnalysisConfig, keys: Sequence[str]) -> Fitted:
    plain = df.drop(*keys)
    # the bound on the target is the larger one: it decides the task and the strata
    numeric_target = S.is_numeric(df.schema[target].dataType)
    texts = _texts(plain, target)
    bounds = dict.fromkeys(texts, MAX_LEVELS)
    bounds[target] = R.CLASS_LIMIT if numeric_target else MAX_CLASSES
    levels = distinct_up_to(df, [*texts, target], bounds)
    m = model_matrix(plain, target, levels=levels)
    if not (m.numeric or m.categorical):
        raise ValueError("no usable features")
    classes = levels[target]
    regression = numeric_target and classes is None
    task = "regression" if regression else "classification"
    y = S.to_number(col(target), df.schema[target].dataType) if regression else S.label(col(target))
    data = df.withColumn("y", y).where(F.col("y").isNotNull())
    if not regression and classes is None:
        raise ValueError(f"more than {MAX_CLASSES} classes in {target}")
    stratify = "y" if classes is not None and classes <= MAX_STRATA else None
    split = split_by_key(data, keys, cfg.random_seed) if keys else split_rows(data, cfg.random_seed, stratify)
    train_rows = split.where(~F.col("is_test"))
    # written once: encoders, fit and scores scan it many times
    prepared = stage(_prepared(split, m, train_rows), "prepared")
    train = prepared.where(~F.col("is_test"))
    test = prepared.where(F.col("is_test"))
    sizes = prepared.agg(F.count_if("is_test").alias("test"), F.count("*").alias("all")).first()
    n_test, n_train = sizes["test"], sizes["all"] - sizes["test"]
    stages = _encoder(m)
    if regression:
        stages.append(LinearRegression(labelCol="y", solver="auto"))
        name = "LinearRegression"
    else:
        indexer = StringIndexer(inputCol="y", outputCol="label", stringOrderType="alphabetAsc").fit(train)
        train = indexer.transform(train)
        # classes that only the test rows have are wrong whatever is predicted
        test = indexer.copy().setHandleInvalid("keep").transform(test)
        # the penalty of unit strength on a sum of losses, per row
        stages.append(LogisticRegression(maxIter=LOGISTIC_ITERATIONS, regParam=1.0 / max(n_train, 1),
                                         standardization=False))
        name = "LogisticRegression"
    fitted = Pipeline(stages=stages).fit(train)
    if not regression:
        _drop_summary(df.sparkSession, fitted.stages[-1])
    predicted = fitted.transform(test)
    record = {
        "enabled": True, "target": target, "task_type": task, "model_name": name,
        "n_train": n_train, "n_test": n_test, "dropped_datetime_cols": m.dropped_datetime,
        "dropped_high_cardinality_cat_cols": m.dropped_categorical,
    }
    if regression:
        scores = regression_scores(predicted.select("y", "prediction")).first()
    else:
        scores = classification_scores(predicted.select("label", "prediction")).first()
    record.update(scores.asDict())
    return Fitted(record, predicted)


def _drop_summary(spark: SparkSession, model: LogisticRegressionModel) -> None:
    """Takes the training summary off a classifier, as tasks get the model with all it holds: the
    summary holds the session, which can't be sent once a table was observed in it."""
    model._java_obj.setSummary(spark._jvm.scala.Option.apply(None))


def regression_scores(df: DataFrame) -> DataFrame:
    """(r2, mae) of columns y and prediction."""
    off = F.col("y") - F.col("prediction")
    return df.agg(
        (1.0 - F.try_divide(F.sum(off * off), F.var_pop("y") * F.count("y"))).alias("r2"),
        F.avg(F.abs(off)).alias("mae"),
    )


def classification_scores(df: DataFrame) -> DataFrame:
    """(accuracy, f1) of columns label and prediction; f1 is the mean over classes."""
    cells = df.groupBy("label", "prediction").agg(F.count("*").alias("c"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("c")).otherwise(0)
    sides = cells.withColumn("hit", hit).select(
        "hit", "c",
        F.explode(F.array(
            F.struct(F.col("label").alias("class"), F.lit(1).alias("true")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).alias("true")),
        )).alias("side"),
    )
    true = F.col("side.true") == 1
    per_class = sides.groupBy("side.class").agg(
        F.sum(F.when(true, F.col("hit")).otherwise(0)).alias("hits"),
        F.sum(F.when(true, F.col("c")).otherwise(0)).alias("actual"),
        F.sum(F.when(~true, F.col("c")).otherwise(0)).alias("predicted"),
    )
    f1 = F.try_divide(2.0 * F.col("hits"), (F.col("actual") + F.col("predicted")).cast("double"))
    return per_class.agg(
        F.try_divide(F.sum("hits").cast("double"), F.sum("actual").cast("double")).alias("accuracy"),
        F.avg(f1).alias("f1"),
    )
