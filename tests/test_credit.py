"""Features, training gate, regression against NumPy, scores."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.checks import credit as checks
from flowlake.plans import credit
from flowlake.session import work_dir

AS_OF = "2024-01-10 00:00:00"


def day(n, hour=0):
    return datetime.datetime(2024, 1, n, hour)


def account(key, consumer=1, product="auto_loan", sanctioned=1000, outstanding=500, dpd="30",
            status="active", opened=day(1), event=day(2)):
    return (key, consumer, 1, product, sanctioned, outstanding, dpd, status, opened, event, day(3))


def features_of(spark, accounts, scores=()):
    import decimal

    rows = [
        tuple(decimal.Decimal(v) if i in (4, 5) and v is not None else v for i, v in enumerate(a))
        for a in accounts
    ]
    a = spark.createDataFrame(rows, schemas.ACCOUNTS)
    s = spark.createDataFrame(list(scores), schemas.SCORES)
    found = credit.credit_features(a, s, AS_OF).collect()
    return {r["account_id"]: (r["label"], r["features"]) for r in found}


def test_feature_vector(spark):
    scores = [(1, 1, 700, "v", "t", day(1), day(3)), (2, 1, 720, "v", "t", day(2), day(3))]
    got = features_of(
        spark,
        [
            account(1),
            account(2, consumer=9, sanctioned=0, product="yacht"),
            account(3, consumer=9, sanctioned=None, product=None),
            account(4, opened=day(20), dpd=None, status="delinquent"),
            account(5, opened=day(8, 1), product="credit_card", dpd="90+"),
            account(6, opened=None, outstanding=None, consumer=None),
        ],
        scores,
    )
    log = math.log(1000)
    assert got[1] == (0, [1.0, 0.5, log, 720.0, 9.0, 0.0, 0.0, 1.0, 0.0])
    assert got[2] == (0, [1.0, 0.0, 0.0, 650.0, 9.0, 0.0, 0.0, 0.0, 0.0])
    assert got[3] == got[2]
    assert got[4][0] == 1 and got[4][1][4] == 0.0
    # 47 hours are one whole day.
    assert got[5][0] == 1 and got[5][1][4:6] == [1.0, 1.0]
    assert got[6][1][:5] == [1.0, 0.0, log, 650.0, 0.0]


def labelled(spark, rows):
    return spark.createDataFrame(
        [(i, i, label, vector) for i, (label, vector) in enumerate(rows)], schemas.RISK_FEATURES
    )


def vector(*head):
    return [1.0, *head, *[0.0] * (8 - len(head))]


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([(i % 2, vector(0.1)) for i in range(19)], "too few rows"),
        ([(1, vector(0.1)) for _ in range(20)], "one class only"),
        ([(i % 2, vector(0.1)) for i in range(20)], None),
    ],
)
def test_train_gate(spark, rows, reason):
    assert credit.train_gate(labelled(spark, rows)).first()["skip_reason"] == reason


def numpy_fit(x, y, rounds=20):
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ beta))
        w = p * (1 - p)
        beta = beta + np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (y - p))
    return beta


@pytest.fixture(scope="module")
def fitted(spark):
    from flowlake.sinks.tables import materialize

    rows = checks.features(spark, "/root/testdata/sf0.001")
    features = materialize(rows, work_dir(spark, "features"))
    data = features.collect()
    x = np.array([r["features"] for r in data])
    y = np.array([r["label"] for r in data], dtype=float)
    return features, x, y, credit.train_credit(features).first()


def test_regression_equals_numpy(fitted):
    features, x, y, model = fitted
    beta = numpy_fit(x, y)
    assert np.allclose(model["coef"], beta, rtol=1e-5, atol=1e-7)
    p = 1 / (1 + np.exp(-x @ beta))
    assert math.isclose(
        model["log_likelihood"], np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)), rel_tol=1e-8
    )
    information = x.T @ (x * (p * (1 - p))[:, None])
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    assert np.allclose(model["std_err"], errors, rtol=1e-4)
    assert np.allclose(model["z_stats"], beta / errors, rtol=1e-4)
    assert np.allclose(model["odds_ratios"], np.exp(beta), rtol=1e-5)
    assert math.isclose(model["condition_no"], np.linalg.cond(information), rel_tol=1e-3)
    assert all(0 <= value <= 1 for value in model["p_values"])
    assert 1 <= model["num_iterations"] <= 20
    assert (model["num_rows_processed"], model["num_rows_skipped"]) == (len(y), 0)


def test_incomplete_rows_are_skipped(spark, fitted):
    features, x, y, model = fitted
    holed = features.unionAll(
        spark.createDataFrame(
            [(-1, -1, 1, [1.0, None, *[0.0] * 7]), (-2, -2, None, [1.0] * 9), (-3, -3, 1, None)],
            schemas.RISK_FEATURES,
        )
    )
    again = credit.train_credit(holed).first()
    assert np.allclose(again["coef"], model["coef"])
    assert (again["num_rows_processed"], again["num_rows_skipped"]) == (len(y), 3)


def test_hopeless_data_ends(spark):
    """Constant features and separable classes still give a model row."""
    constant = labelled(spark, [(i % 2, vector(0.5, 1.0)) for i in range(40)])
    assert len(credit.train_credit(constant).first()["coef"]) == 9
    apart = labelled(spark, [(int(i >= 20), vector(float(i))) for i in range(40)])
    model = credit.train_credit(apart).first()
    assert model["coef"][1] > 0 and model["num_iterations"] <= 20


def test_scores_and_tiers(spark):
    features = labelled(spark, [(1, vector(2.0)), (0, vector(0.0)), (0, vector(-2.0))])
    model = spark.createDataFrame([([0.0, 1.0, *[0.0] * 7],)], "coef array<double>")
    scored = credit.score_accounts(features, model)
    rows = {r["account_id"]: r for r in scored.collect()}
    assert math.isclose(rows[0]["probability_delinquent"], 1 / (1 + math.exp(-2)))
    assert [rows[i]["risk_tier"] for i in range(3)] == ["high", "medium", "low"]
    assert [f.name for f in scored.schema] == [
        "account_id", "consumer_id", "actual_delinquent", "probability_delinquent", "risk_tier"
    ]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "hashpartitioning" not in plan


def test_run_without_enough_data_leaves_empty_scores(spark):
    accounts = spark.createDataFrame([], schemas.ACCOUNTS)
    scores = spark.createDataFrame([], schemas.SCORES)
    run = credit.run_credit(spark, accounts, scores, work_dir(spark, "credit"), AS_OF)
    assert run.model is None and run.skip_reason == "too few rows"
    assert run.scores.count() == 0 and run.summary.count() == 0
    assert [f.name for f in run.scores.schema][-1] == "risk_tier"


def test_whole_run(spark):
    run = checks.credit_run(spark, "/root/testdata/sf0.001")
    assert run.skip_reason is None
    accounts = run.features.count()
    assert accounts == run.scores.count()
    assert run.summary.agg(F.sum("accounts")).first()[0] == accounts
    for row in run.summary.collect():
        low = {"high": 0.7, "medium": 0.4, "low": 0.0}[row["risk_tier"]]
        assert row["avg_probability"] >= low
