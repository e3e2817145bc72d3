"""Multinomial product models on ``pyspark.ml``.

Training is distributed (tree aggregation over partitions); what reaches the
driver is the coefficient matrix, whose size is classes x predictors.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.columns import ratio


def predictors(formula: str) -> list[str]:
    """Column names on the right-hand side."""
    return list(dict.fromkeys(re.findall(r"[A-Za-z_]\w*", formula.split("~", 1)[1])))


def scorable(rows: DataFrame, formula: str) -> Column:
    """No numeric predictor is null: text predictors have a level of their own for null."""
    text = {f.name for f in rows.schema if f.dataType.simpleString() == "string"}
    known = F.lit(True)
    for c in predictors(formula):
        if c not in text:
            known = known & F.col(c).isNotNull()
    return known


def fit_multinomial(rows: DataFrame, formula: str, reg: float = 1e-3, iters: int = 200):
    """Fit ``label ~ a + b + a:b``; text predictors are indexed and one-hot encoded.

    A null text, and when scoring a level the fit never saw, is a level of its
    own. Rows without a label or with a null numeric predictor cannot be fitted;
    scoring gives them a null probability and counts them. The model says in
    ``converged`` whether it ended before ``iters``.
    """
    label, right = (x.strip() for x in formula.split("~", 1))
    known = rows.where(scorable(rows, formula) & F.col(label).isNotNull())
    names = StringIndexer(inputCol=label, outputCol="label", handleInvalid="error",
                          stringOrderType="alphabetAsc")
    encode = RFormula(formula=f"~ {right}", featuresCol="features", handleInvalid="keep",
                      stringIndexerOrderType="alphabetAsc")
    fit = LogisticRegression(family="multinomial", maxIter=iters, regParam=reg, tol=1e-8)
    model = Pipeline(stages=[names, encode, fit]).fit(known)
    model.stages[0].setHandleInvalid("keep")
    model.formula = formula
    model.converged = model.stages[-1].summary.totalIterations < iters
    return model


def scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every row with ``probabilities``: null where a numeric predictor is null."""
    ok = scorable(rows, model.formula)
    fill = {c: 0 for c in predictors(model.formula)
            if dict(rows.dtypes).get(c) not in (None, "string")}
    whole = rows.withColumn("__ok", ok)
    held = {c: F.col(c) for c in fill}
    whole = whole.withColumns({f"__was_{c}": x for c, x in held.items()}).na.fill(0, list(fill))
    out = model.transform(whole).withColumn(
        "probabilities", F.when(F.col("__ok"), vector_to_array("probability")))
    return out.drop(*fill).withColumnsRenamed({f"__was_{c}": c for c in fill}).drop("__ok")


def labels_of(model: PipelineModel, rows: DataFrame | None = None) -> list[str]:
    """Class names in the model's order."""
    return list(model.stages[0].labels)


def feature_names(model: PipelineModel, rows: DataFrame) -> list[str]:
    """Predictor names from the encoded column's metadata (a schema, not data)."""
    field = model.stages[1].transform(rows).schema["features"]
    attrs = field.metadata["ml_attr"]["attrs"]
    flat = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(flat, key=lambda a: a["idx"])]


def log_loss(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """One row: rows, rows that cannot be scored, log-likelihood of the rest.

    A class the fit never saw has the probability 1e-15.
    """
    label = model.formula.split("~", 1)[0].strip()
    at = F.array_position(F.array(*map(F.lit, labels_of(model))), F.col(label)).cast("int") - 1
    p = F.when(at >= 0, F.get("probabilities", at)).otherwise(F.lit(0.0))
    open_ = F.col("probabilities").isNull() | F.col(label).isNull()
    return scored(model, rows).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(open_).alias("unscored"),
        F.sum(F.when(~open_, F.ln(F.greatest(p, F.lit(1e-15))))).alias("loglik"),
    )


def _rank(model: PipelineModel, rows: DataFrame) -> int:
    """Independent encoded predictors: every level has a column, so they depend on each other."""
    coded = model.stages[1].transform(rows).select("features")
    corr = Correlation.corr(coded, "features").first()[0].toArray()
    return int(np.linalg.matrix_rank(np.nan_to_num(corr), tol=1e-8))


def compare_models(models: Mapping[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Nested models on the same rows: log-loss, parameters, likelihood ratio to the first.

    The ratio is one of likelihoods for fits without a penalty (``reg=0``). Rows
    that one of the models cannot score are left out for all and counted.
    """
    ok = F.lit(True)
    for m in models.values():
        ok = ok & scorable(rows, m.formula) & F.col(m.formula.split("~", 1)[0].strip()).isNotNull()
    common = rows.where(ok)
    out = None
    for i, (name, m) in enumerate(models.items()):
        params = (len(labels_of(m)) - 1) * (_rank(m, common) + 1)
        one = log_loss(m, common).select(
            F.lit(i).alias("step"), F.lit(name).alias("model"),
            F.lit(params).alias("parameters"), "n", "loglik",
            (-ratio("loglik", "n")).alias("log_loss"), F.lit(m.converged).alias("converged"),
        )
        out = one if out is None else out.unionByName(one)
    out = out.withColumn("unscored", F.lit(rows.count()) - F.col("n"))
    w = W.orderBy("step")  # one row per model
    return out.withColumn(
        "lr_statistic", 2 * (F.col("loglik") - F.first("loglik").over(w))
    ).withColumn("lr_df", F.col("parameters") - F.first("parameters").over(w))


def vif(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation per numeric predictor, 1 / (1 - R2) of its regression on the others.

    Infinite for a predictor the others determine, null for one that is constant.
    Rows with a null predictor are left out.
    """
    rows = rows.select(*(F.col(c).cast("double").alias(c) for c in cols)).na.drop()
    stats = rows.agg(*[F.var_samp(c).alias(c) for c in cols]).first()
    used = [c for c in cols if stats[c]]
    found: dict[str, float | None] = {}
    if used:
        packed = VectorAssembler(inputCols=used, outputCol="v").transform(rows).select("v")
        corr = Correlation.corr(packed, "v").first()[0].toArray()
        for i, c in enumerate(used):
            rest = [j for j in range(len(used)) if j != i]
            r = corr[rest, i]
            left = 1.0 - float(r @ np.linalg.pinv(corr[np.ix_(rest, rest)], rcond=1e-10) @ r)
            found[c] = float("inf") if left < 1e-9 else max(1.0, 1.0 / left)
    return rows.sparkSession.createDataFrame(
        [(c, found.get(c)) for c in cols], "predictor string, vif double"
    )


def odds_ratios(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Odds ratio of each predictor per class, against the average class."""
    lr = model.stages[-1]
    coef, names = lr.coefficientMatrix.toArray(), feature_names(model, rows)
    classes = labels_of(model, rows)
    table = [
        (k, n, float(coef[i, j]), float(np.exp(coef[i, j])))
        for i, k in enumerate(classes) for j, n in enumerate(names)
    ]
    return rows.sparkSession.createDataFrame(
        table, "category string, predictor string, coefficient double, odds_ratio double"
    )


def score_long(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """One row per input row and class with the fitted probability.

    A row that cannot be scored gives one row with null category and probability.
    """
    classes = F.array(*[F.lit(c) for c in labels_of(model, rows)])
    return scored(model, rows).select(
        *rows.columns, F.posexplode_outer("probabilities").alias("__i", "probability")
    ).withColumn("category", F.get(classes, F.col("__i"))).drop("__i")


def predicted_counts(model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """How often each class is the most likely one, beside how often it occurs.

    The null category counts rows without a class, and rows that cannot be scored.
    """
    classes = F.array(*[F.lit(c) for c in labels_of(model, rows)])
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1
    top = F.get(classes, best)
    predicted = scored(model, rows).groupBy(top.alias("category")).agg(F.count(F.lit(1)).alias("predicted"))
    observed = rows.groupBy(F.col(label).alias("category")).agg(
        F.count(F.lit(1)).alias("observed")
    )
    both = observed.withColumnRenamed("category", "__c").join(
        predicted, F.col("__c").eqNullSafe(F.col("category")), "full")
    return both.select(
        F.coalesce("__c", "category").alias("category"),
        F.coalesce("observed", F.lit(0)).alias("observed"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))


def effect_grid(
    model: PipelineModel, rows: DataFrame, label: str, levels: Mapping[str, Sequence],
    held: Sequence[str],
) -> DataFrame:
    """Predictions over every combination of ``levels``, other predictors at their mean.

    The grid is exploded from literal arrays: its size is the product of the
    level counts, whatever the data's size.
    """
    grid = rows.agg(*[F.avg(c).alias(c) for c in held],
                    F.first(label, ignorenulls=True).alias(label))
    for c, values in levels.items():
        grid = grid.withColumn(c, F.explode(F.array(*[F.lit(v) for v in values])))
    classes = labels_of(model, rows)
    names = F.array(*[F.lit(c) for c in classes])
    return scored(model, grid).select(*levels, F.posexplode("probabilities").alias("__i", "probability")).withColumn(
        "category", F.get(names, F.col("__i"))
    ).drop("__i")
