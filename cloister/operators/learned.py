"""Measures that need a model, with Spark's own learners: results are comparable with other learners, not equal to them."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import APP, KPIS, PROVINCE, RAT, Settings
from ..functions.columns import in_majority_part
from .attacks import ROW

LABELS = (RAT, PROVINCE, APP)


def _stages(numbers: list[str], labels: list[str]) -> list:
    filled = [f"{c}_filled" for c in numbers]
    return [
        Imputer(strategy="median", inputCols=numbers, outputCols=filled),
        *[StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in labels],
        VectorAssembler(inputCols=[*filled, *[f"{c}_index" for c in labels]], outputCol="features", handleInvalid="keep"),
    ]


def downstream(orig: DataFrame, anon: DataFrame, row: str = "row_id", target: str = "tp_dl_avg", settings: Settings = Settings(), rounds: int = 10) -> DataFrame:
    """M8: (item, value, status): models for throughput, trained on the release, against ones trained on the original, both
    tested on the same three tenths of the original: R2 kept (0.95 passes) and F1 of the lowest fifth kept (0.90 passes)."""
    numbers = [c for c in KPIS if c not in (target, "tp_dl_filtered_avg") and c in orig.columns and c in anon.columns]
    labels = [c for c in LABELS if c in orig.columns and c in anon.columns]
    texts = lambda df: df.filter(F.col(target).isNotNull()).select(row, F.log1p(target).alias("y"), F.col(target).alias("t"), *numbers, *[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in labels])
    everything, released = texts(orig), texts(anon)
    inside = in_majority_part(settings.seed, F.col(row))
    train, test = everything.filter(inside), everything.filter(~inside)
    low = train.agg(F.percentile_approx("t", 0.2, 10000)).first()[0]
    out: dict[str, tuple[float, float]] = {}
    base = Pipeline(stages=_stages(numbers, labels)).fit(everything)
    held = base.transform(test.withColumn("poor", (F.col("t") < low).cast("double")))
    for name, part in (("orig", train), ("anon", released)):
        seen = base.transform(part.withColumn("poor", (F.col("t") < low).cast("double")))
        fitted = GBTRegressor(labelCol="y", maxIter=rounds, seed=settings.seed, maxBins=64).fit(seen).transform(held)
        e = fitted.agg(F.sum(F.pow(F.col("y") - F.col("prediction"), F.lit(2.0))).alias("res"), (F.var_pop("y") * F.count("y")).alias("tot")).first()
        guessed = GBTClassifier(labelCol="poor", maxIter=rounds, seed=settings.seed, maxBins=64).fit(seen).transform(held)
        yes = (F.col("prediction") == 1) & (F.col("poor") == 1)
        f = guessed.agg(F.count(F.when(yes, 1)).alias("tp"), F.count(F.when(F.col("prediction") == 1, 1)).alias("p"), F.count(F.when(F.col("poor") == 1, 1)).alias("n")).first()
        out[name] = (1 - e["res"] / e["tot"] if e["tot"] else float("nan"), 2 * f["tp"] / (f["p"] + f["n"]) if f["p"] + f["n"] else float("nan"))
    ratio = lambda k: out["anon"][k] / out["orig"][k] if out["orig"][k] > 0 else None
    rows = [("r2_ratio", ratio(0), 0.95), ("f1_ratio", ratio(1), 0.90)]
    return orig.sparkSession.createDataFrame([(n, v, "PASS" if v is not None and v >= least else "FAIL") for n, v, least in rows], "item string, value double, status string")


def application_recovery(a: DataFrame, r: DataFrame, settings: Settings = Settings(), trees: int = 20) -> DataFrame:
    """(restricted_rows, accuracy): suppressed applications recovered from the measurements and the hour of day by a forest
    that learns from the rows that kept theirs. Null where there is nothing to learn from or to recover."""
    numbers = [c for c in KPIS if c in a.columns] + ["hod"]
    rows = a.select(F.col(ROW).alias("row"), "app_gone", F.col(APP).cast("string").alias("label"), *[F.col(c).cast("double").alias(c) for c in numbers])
    known, gone = rows.filter("not app_gone and label is not null"), rows.filter("app_gone")
    spark = a.sparkSession
    if known.isEmpty() or gone.isEmpty():
        return spark.createDataFrame([(gone.count(), None)], "restricted_rows long, accuracy double")
    index = StringIndexer(inputCol="label", outputCol="y", handleInvalid="keep").fit(known)
    base = Pipeline(stages=_stages(numbers, [])).fit(known)
    model = RandomForestClassifier(labelCol="y", numTrees=trees, maxDepth=8, seed=settings.seed).fit(base.transform(index.transform(known)))
    guess = model.transform(base.transform(gone.drop("label"))).select("row", "prediction")
    names = F.array(*[F.lit(x) for x in index.labels])
    truth = r.select(F.col(ROW).alias("row"), F.col(APP).cast("string").alias("true"))
    met = guess.join(truth, "row").select((F.get(names, F.col("prediction").cast("int")) == F.col("true")).cast("double").alias("hit"))
    return met.agg(F.count("*").alias("restricted_rows"), F.avg(F.coalesce("hit", F.lit(0.0))).alias("accuracy"))
