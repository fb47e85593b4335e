"""Credit risk: latest state, features, logistic regression, scores and tiers."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.functions import rules, vectors
from flowlake.functions.casts import as_of_column
from flowlake.operators.joins import lookup_join
from flowlake.operators.kpi import tier_summary
from flowlake.operators.latest import latest_accounts, latest_scores
from flowlake.sinks.tables import materialize

# Slots of the feature vector behind the constant, the score of a consumer
# without one, and the products with a slot of their own (line_of_credit has none).
FEATURES = (
    "intercept", "utilization", "log_sanctioned", "score", "age_days",
    "credit_card", "personal_loan", "auto_loan", "mortgage",
)
NEUTRAL_SCORE = 650
PRODUCTS = FEATURES[5:]

# The latest-row aggregate carries every column it is given, so it is given only these.
LATEST_BY = ("event_ts", "ingested_ts")
ACCOUNT_INPUTS = (
    "account_id", "consumer_id", "product", "sanctioned_amount", "outstanding_amount",
    "dpd_bucket", "status", "opened_ts", *LATEST_BY,
)
SCORE_INPUTS = ("consumer_id", "score_value", "score_ts", "ingested_ts")

# When training is worth it, and how long it may run.
MIN_ROWS = 20
MIN_CLASSES = 2
MAX_ITERATIONS = 20

MODEL = """
    coef ARRAY<DOUBLE>, log_likelihood DOUBLE, std_err ARRAY<DOUBLE>, z_stats ARRAY<DOUBLE>,
    p_values ARRAY<DOUBLE>, odds_ratios ARRAY<DOUBLE>, condition_no DOUBLE,
    num_iterations INT, num_rows_processed BIGINT, num_rows_skipped BIGINT
"""


def feature_vector(as_of=None) -> Column:
    """Nine doubles, never NULL. Age counts whole days and is not negative."""
    used = F.col("outstanding_amount") / F.nullif(F.col("sanctioned_amount"), F.lit(0))
    age = F.timestamp_diff("DAY", F.col("opened_ts"), as_of_column(as_of))
    slots = [
        F.lit(1.0),
        F.coalesce(used, F.lit(0)),
        F.log(F.greatest(F.col("sanctioned_amount"), F.lit(1)).cast("double")),
        F.coalesce(F.col("score_value"), F.lit(NEUTRAL_SCORE)),
        F.greatest(age, F.lit(0)),
        *[F.when(F.col("product") == name, 1).otherwise(0) for name in PRODUCTS],
    ]
    return F.array(*[slot.cast("double") for slot in slots])


class State(NamedTuple):
    """The latest row of each account, and the latest score of each consumer."""

    accounts: DataFrame
    scores: DataFrame


def latest_state(accounts: DataFrame, scores: DataFrame) -> State:
    latest = latest_accounts(accounts.select(*ACCOUNT_INPUTS))
    return State(latest, latest_scores(scores.select(*SCORE_INPUTS)).select("consumer_id", "score_value"))


def write_state(accounts: DataFrame, scores: DataFrame, path: str) -> State:
    """The latest state as tables below ``path``: each feed is read once, whatever is made of it."""
    latest = latest_state(accounts, scores)
    return State(materialize(latest.accounts, f"{path}/accounts"), materialize(latest.scores, f"{path}/scores"))


def read_state(spark: SparkSession, path: str) -> State:
    return State(spark.read.parquet(f"{path}/accounts"), spark.read.parquet(f"{path}/scores"))


def credit_features(accounts: DataFrame, scores: DataFrame, as_of=None) -> DataFrame:
    """Label and features of every latest account, with its consumer's latest score."""
    return features_of(latest_state(accounts, scores), as_of)


def features_of(state: State, as_of=None) -> DataFrame:
    """Label and features of a state's accounts. The join reads the accounts twice, so the state
    should be written (``write_state``)."""
    joined = lookup_join(state.accounts, state.scores, "consumer_id", spread=["account_id"])
    return joined.select(
        "account_id",
        "consumer_id",
        rules.delinquent_label(F.col("dpd_bucket"), F.col("status")).alias("label"),
        feature_vector(as_of).alias("features"),
    )


def train_gate(features: DataFrame) -> DataFrame:
    """One row: how many rows and classes there are, and why not to train (NULL if fit)."""
    counts = features.agg(
        F.count("*").alias("n_rows"), F.countDistinct("label").alias("n_classes")
    )
    reason = F.when(F.col("n_rows") < MIN_ROWS, "too few rows").when(
        F.col("n_classes") < MIN_CLASSES, "one class only"
    )
    return counts.withColumn("skip_reason", reason)


def complete(features: DataFrame) -> DataFrame:
    whole = F.col("label").isNotNull() & ~F.exists("features", lambda x: x.isNull())
    return features.filter(F.col("features").isNotNull() & whole)


def train_credit(features: DataFrame, max_iterations: int = MAX_ITERATIONS) -> DataFrame:
    """Logistic regression by iteratively reweighted least squares; the model as one row.

    Slot 0 is the constant. The solver gets the other eight and fits an intercept, as a constant
    column of its own would be dropped as having no variance.
    """
    rows = complete(features)
    inputs = rows.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.slice("features", 2, len(FEATURES) - 1)).alias("inputs"),
    )
    solver = GeneralizedLinearRegression(
        family="binomial", link="logit", maxIter=max_iterations, featuresCol="inputs"
    )
    # Every iteration is a pass over the inputs; what does not fit in memory goes to disk.
    inputs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = solver.fit(inputs)
        coef = [float(fit.intercept), *map(float, fit.coefficients)]
        iterations = fit.summary.numIterations
    finally:
        inputs.unpersist()
    return model_row(features, coef, iterations)


def model_row(features: DataFrame, coef: list[float], iterations: int) -> DataFrame:
    """Fit statistics of the coefficients, from one aggregate over the features.

    The information matrix is 9 x 9, so its 45 sums are plain aggregate columns; standard
    errors and the condition number follow on the driver.
    """
    size = len(coef)
    rows = complete(features).select(
        "label",
        vectors.dot(F.col("features"), F.array(*map(F.lit, coef))).alias("margin"),
        *[F.col("features")[i].alias(f"x{i}") for i in range(size)],
    )
    chance = vectors.sigmoid(F.col("margin"))
    # log(1 + exp(m)) without overflow for large margins.
    log_odds = F.greatest(F.col("margin"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin")))
    rows = rows.withColumns(
        {
            "weight": chance * (1 - chance),
            "log_likelihood": F.col("label") * F.col("margin") - log_odds,
        }
    )
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = rows.agg(
        F.count("*").alias("n"),
        F.sum("log_likelihood").alias("log_likelihood"),
        *[
            F.sum(F.col("weight") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}")
            for i, j in pairs
        ],
    ).first()
    information = np.zeros((size, size))
    for i, j in pairs:
        information[i, j] = information[j, i] = sums[f"h{i}_{j}"]
    total = features.count()
    return features.sparkSession.createDataFrame(
        [(coef, sums["log_likelihood"], *_wald(information, coef), int(iterations), sums["n"],
          total - sums["n"])],
        MODEL,
    )


def _wald(information: np.ndarray, coef: list[float]):
    """Standard errors, z statistics, p-values, odds ratios and the condition number."""
    try:
        variance = np.diag(np.linalg.inv(information))
        std_err = [math.sqrt(v) if v > 0 else math.nan for v in variance]
    except np.linalg.LinAlgError:
        std_err = [math.nan] * len(coef)
    z = [b / s if s else math.nan for b, s in zip(coef, std_err)]
    p = [math.erfc(abs(v) / math.sqrt(2)) for v in z]
    odds = [math.exp(b) if b < 709.0 else math.inf for b in coef]
    return std_err, z, p, odds, float(np.linalg.cond(information))


def score_accounts(features: DataFrame, model: DataFrame) -> DataFrame:
    """Probability and tier of every account. The model is one row, so it is broadcast."""
    margin = vectors.dot(F.col("coef"), F.col("features"))
    one = F.assert_true(F.count("*") == 1, "a model has one row")
    coef = model.agg(F.first("coef").alias("coef"), one.alias("one")).filter("one IS NULL")
    rows = features.crossJoin(F.broadcast(coef))
    return rows.select(
        "account_id",
        "consumer_id",
        F.col("label").alias("actual_delinquent"),
        vectors.sigmoid(margin).alias("probability_delinquent"),
    ).withColumn("risk_tier", rules.risk_tier(F.col("probability_delinquent")))


def top_risk(scores: DataFrame, accounts: DataFrame, n: int = 20) -> DataFrame:
    """The accounts most likely delinquent, with their current state."""
    shown = ["account_id", "product", "outstanding_amount", "dpd_bucket", "status"]
    return _top(scores, latest_accounts(accounts.select(*shown, *LATEST_BY)).drop(*LATEST_BY), n)


def top_risk_of(scores: DataFrame, state: State, n: int = 20) -> DataFrame:
    """``top_risk`` of a state that is there already."""
    return _top(scores, state.accounts.select("account_id", "product", "outstanding_amount", "dpd_bucket", "status"), n)


def _top(scores: DataFrame, state: DataFrame, n: int) -> DataFrame:
    order = [F.desc_nulls_first("probability_delinquent"), F.asc("account_id")]
    return scores.join(state, "account_id").orderBy(*order).limit(n)


@dataclass(frozen=True)
class CreditRun:
    """Tables a credit run left behind; ``model`` is None where training was skipped."""

    features: DataFrame
    model: DataFrame | None
    scores: DataFrame
    summary: DataFrame
    skip_reason: str | None


def run_credit(
    spark: SparkSession, accounts: DataFrame, scores: DataFrame, path: str, as_of=None
) -> CreditRun:
    """Features, model and scores as tables below ``path``, and the tier summary.

    The latest state is written once, and the features before training: the solver reads them once per iteration, and
    a lost executor must not redo the joins.
    """
    state = write_state(accounts, scores, f"{path}/state")
    features = materialize(features_of(state, as_of), f"{path}/features")
    reason = train_gate(features).first()["skip_reason"]
    if reason:
        model = None
        scored = spark.createDataFrame([], schemas.RISK_SCORES)
    else:
        model = materialize(train_credit(features), f"{path}/model")
        scored = score_accounts(features, model)
    scored = materialize(scored, f"{path}/scores")
    return CreditRun(features, model, scored, tier_summary(scored), reason)
