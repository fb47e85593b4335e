"""Change feed, latest state, merge, features, model and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import schemas
from flowlake.checks import fixtures as fx
from flowlake.checks.registry import check, written_once
from flowlake.functions import vectors
from flowlake.operators import kpi, latest, merge, parse, reconcile, topk
from flowlake.plans import adhoc, credit
from flowlake.plans.bulk_load import reject_counts
from flowlake.session import work_dir

ACCOUNTS = fx.ctes("fx_account_changes")
SCORES = fx.ctes("fx_scores")
BOTH = fx.ctes("fx_account_changes", "fx_scores")
AS_OF = fx.CREDIT_AS_OF
BACKFILL_SCORE = 600

# Any coefficients will do as long as all three tiers occur.
COEF = [-2.0, 6.0, 0.1, -0.002, 0.0001, 0.5, 0.4, -0.1, -0.3]

ACCOUNT_SQL = """account_id, consumer_id, lender_id, product,
  CAST(sanctioned_amount AS DOUBLE) AS sanctioned_amount,
  CAST(outstanding_amount AS DOUBLE) AS outstanding_amount, dpd_bucket, status,
  make_timestamp(opened_ms * 1000) AS opened_ts, make_timestamp(event_ms * 1000) AS event_ts"""
SCORE_SQL = """score_event_id, consumer_id, score_value, score_version, score_trigger,
  make_timestamp(score_ms * 1000) AS score_ts"""

LATEST_ACCOUNTS = """a AS (SELECT * FROM fx_account_changes
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_ms DESC) = 1)"""
LATEST_SCORES = """s AS (SELECT * FROM fx_scores
  QUALIFY row_number() OVER (PARTITION BY consumer_id ORDER BY score_ms DESC) = 1)"""

FEATURES = f"""{BOTH}, {LATEST_ACCOUNTS}, {LATEST_SCORES}, f AS (
SELECT a.account_id, a.consumer_id,
  CAST(a.dpd_bucket = '60' OR a.dpd_bucket = '90+' OR a.status = 'delinquent' AS INT) AS label,
  CAST(1 AS DOUBLE) AS f0,
  CAST(a.outstanding_amount AS DOUBLE) / CAST(a.sanctioned_amount AS DOUBLE) AS f1,
  ln(CAST(greatest(a.sanctioned_amount, 1) AS DOUBLE)) AS f2,
  CAST(coalesce(s.score_value, 650) AS DOUBLE) AS f3,
  CAST(greatest((epoch_ms(TIMESTAMP '{AS_OF}') - a.opened_ms) // 86400000, 0) AS DOUBLE) AS f4,
  CAST(a.product = 'credit_card' AS DOUBLE) AS f5, CAST(a.product = 'personal_loan' AS DOUBLE) AS f6,
  CAST(a.product = 'auto_loan' AS DOUBLE) AS f7, CAST(a.product = 'mortgage' AS DOUBLE) AS f8
FROM a LEFT JOIN s ON s.consumer_id = a.consumer_id)"""

MARGIN = " + ".join(f"({c}) * f{i}" for i, c in enumerate(COEF))
SCORED = f"""{FEATURES}, p AS (
SELECT account_id, consumer_id, label AS actual_delinquent,
  1.0 / (1.0 + exp(-({MARGIN}))) AS probability_delinquent FROM f),
scored AS (SELECT *, CASE WHEN probability_delinquent < 0.4 THEN 'low'
  WHEN probability_delinquent < 0.7 THEN 'medium' ELSE 'high' END AS risk_tier FROM p) """


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account change log, parsed from its topic."""
    rows = parse.accounts_from_cdc(fx.account_messages(spark, sf_dir), fx.AS_OF)
    good, _ = parse.split_rejects(rows)
    return parse.target_rows(good, schemas.ACCOUNTS, *parse.POSITION)


def account_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(spark, sf_dir).drop(*parse.POSITION)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.scores_from_cdc(fx.score_messages(spark, sf_dir), fx.AS_OF)
    good, _ = parse.split_rejects(rows)
    return parse.target_rows(good, schemas.SCORES)


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Typed accounts and scores as tables, so that no query of them parses a feed again."""

    def table(name: str, rows) -> DataFrame:
        path = written_once(spark, sf_dir, f"feed-{name}", lambda p: rows(spark, sf_dir).write.parquet(p))
        return spark.read.schema(rows(spark, sf_dir).schema).parquet(path)

    return table("accounts", account_rows), table("scores", scores)


def state(spark: SparkSession, sf_dir: str) -> credit.State:
    """Latest accounts and scores, written once."""
    path = written_once(
        spark, sf_dir, "credit-state", lambda p: credit.write_state(*feeds(spark, sf_dir), p)
    )
    return credit.read_state(spark, path)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.features_of(state(spark, sf_dir), AS_OF)


def fixed_model(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.array(*map(F.lit, COEF)).alias("coef"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.score_accounts(features(spark, sf_dir), fixed_model(spark))


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("probability_delinquent", F.round("probability_delinquent", 9))


@check(f"{ACCOUNTS} SELECT {ACCOUNT_SQL} FROM fx_account_changes")
def src_cdc_rows(spark, sf_dir):
    return account_rows(spark, sf_dir).drop("ingested_ts")


@check(f"{SCORES} SELECT {SCORE_SQL} FROM fx_scores")
def parse_scores(spark, sf_dir):
    return scores(spark, sf_dir).drop("ingested_ts")


@check(f"""{fx.ctes('fx_inquiries')} SELECT inquiry_id, consumer_id, lender_id, purpose, channel,
inquiry_ts FROM fx_inquiries""")
def parse_inquiries(spark, sf_dir):
    rows = parse.inquiries_from_json(fx.inquiry_messages(spark, sf_dir))
    good, _ = parse.split_rejects(rows)
    return parse.target_rows(good, schemas.INQUIRIES).drop("ingested_ts")


@check(f"""{fx.ctes('fx_account_changes', 'fx_scores', 'fx_inquiries')}
SELECT seq // 4 AS feed_id, lender_id, 'oltp.credit_accounts' AS source_topic,
  CAST(seq % 4 AS INT) AS source_partition, 'account_update' AS payload_type,
  'cdc' AS feed_channel, make_timestamp(event_ms * 1000) AS event_ts FROM fx_account_changes
UNION ALL SELECT seq // 4, 0, 'oltp.bureau_score_events', CAST(seq % 4 AS INT), 'score_refresh',
  'cdc', make_timestamp(score_ms * 1000) FROM fx_scores
UNION ALL SELECT seq // 4, lender_id, 'events.credit_inquiries', CAST(seq % 4 AS INT), 'inquiry',
  'streaming', inquiry_ts FROM fx_inquiries""")
def landing(spark, sf_dir):
    """The audit rows of the three feeds."""
    parts = [
        (parse.accounts_from_cdc(fx.account_messages(spark, sf_dir)),
         ("account_update", "cdc", "event_ts")),
        (parse.scores_from_cdc(fx.score_messages(spark, sf_dir)),
         ("score_refresh", "cdc", "score_ts", None)),
        (parse.inquiries_from_json(fx.inquiry_messages(spark, sf_dir)),
         ("inquiry", "streaming", "inquiry_ts")),
    ]
    frames = [parse.landing_rows(parse.split_rejects(rows)[0], *tags) for rows, tags in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).drop("ingested_ts")


@check(f"{ACCOUNTS}, {LATEST_ACCOUNTS} SELECT {ACCOUNT_SQL} FROM a")
def accounts_latest(spark, sf_dir):
    return latest.latest_accounts(account_rows(spark, sf_dir)).drop("ingested_ts")


@check(f"{SCORES}, {LATEST_SCORES} SELECT {SCORE_SQL} FROM s")
def scores_latest(spark, sf_dir):
    return latest.latest_scores(scores(spark, sf_dir)).drop("ingested_ts")


@check(f"{ACCOUNTS}, {LATEST_ACCOUNTS} SELECT {ACCOUNT_SQL} FROM a")
def merge_accounts(spark, sf_dir):
    """The change log as batches of 512 messages a partition, merged."""
    changes = accounts(spark, sf_dir).withColumn("batch_id", F.expr("offset div 512"))
    merged = merge.merge_changes(changes)
    return parse.target_rows(merged, schemas.ACCOUNTS).drop("ingested_ts")


@check(f"""{ACCOUNTS}, c AS (SELECT *, seq * 13 % 5 AS batch, product || '/' || CAST(seq % 7 AS VARCHAR)
  AS product_now FROM fx_account_changes),
i AS (SELECT * FROM c QUALIFY row_number() OVER
  (PARTITION BY account_id ORDER BY batch, event_ms DESC) = 1),
n AS (SELECT * FROM c QUALIFY row_number() OVER
  (PARTITION BY account_id ORDER BY event_ms DESC) = 1)
SELECT i.account_id, i.product_now AS product, CAST(n.outstanding_amount AS DOUBLE)
  AS outstanding_amount, n.dpd_bucket, n.status, make_timestamp(n.event_ms * 1000) AS event_ts
FROM i JOIN n ON n.account_id = i.account_id""")
def merge_late_changes(spark, sf_dir):
    """Batches out of event order, and a product that changes though no merge updates it."""
    seq = F.col("offset") * fx.PARTITIONS + F.col("partition")
    now = F.concat("product", F.lit("/"), (seq % 7).cast("string"))
    changes = accounts(spark, sf_dir).withColumns({"batch_id": seq * 13 % 5, "product": now})
    return merge.merge_changes(changes).select(
        "account_id", "product", "outstanding_amount", "dpd_bucket", "status", "event_ts"
    )


@check(f"""{ACCOUNTS}, m AS (SELECT (seq // 4) % 7 AS c FROM fx_account_changes)
SELECT CASE c WHEN 1 THEN 'no_value' WHEN 3 THEN 'missing:account_id'
  ELSE 'bad_value:event_ts' END AS reject_reason, COUNT(*) AS "rows"
FROM m WHERE c IN (1, 3, 5) GROUP BY 1""")
def reject_changes(spark, sf_dir):
    return reject_counts(parse.accounts_from_cdc(fx.spoiled_account_messages(spark, sf_dir)))


@check(f"""{ACCOUNTS}, {LATEST_ACCOUNTS} SELECT account_id, status FROM a
WHERE status NOT IN ('Closed', 'Charged-off')""")
def open_accounts(spark, sf_dir):
    state = latest.latest_accounts(account_rows(spark, sf_dir))
    return adhoc.open_accounts(state).select("account_id", "status")


@check(f"""{ACCOUNTS}, {LATEST_ACCOUNTS} SELECT account_id, CAST(outstanding_amount AS DOUBLE)
AS outstanding_amount, CAST(sanctioned_amount AS DOUBLE) AS sanctioned_amount, product FROM a
ORDER BY md5('flow' || CAST(account_id AS VARCHAR)), account_id LIMIT 25""")
def sample_accounts(spark, sf_dir):
    state = latest.latest_accounts(account_rows(spark, sf_dir))
    drawn = topk.sample_n(state, 25, "account_id", "flow")
    return drawn.select("account_id", "outstanding_amount", "sanctioned_amount", "product")


@check(f"""{ACCOUNTS}, {LATEST_ACCOUNTS} SELECT {ACCOUNT_SQL} FROM a
ORDER BY event_ms DESC, account_id LIMIT 20""")
def recent_accounts(spark, sf_dir):
    state = latest.latest_accounts(account_rows(spark, sf_dir))
    return adhoc.recent_accounts(state).drop("ingested_ts")


@check(f"{SCORES} SELECT {SCORE_SQL} FROM fx_scores ORDER BY score_ms DESC, score_event_id LIMIT 20")
def recent_scores(spark, sf_dir):
    rows = topk.recent_rows(scores(spark, sf_dir), "score_ts", 20, tie=["score_event_id"])
    return rows.drop("ingested_ts")


@check(f"""{BOTH} SELECT 'credit_accounts' AS tbl, COUNT(DISTINCT account_id) AS n
FROM fx_account_changes UNION ALL SELECT 'bureau_score_events', COUNT(*) FROM fx_scores""")
def cdc_counts(spark, sf_dir):
    changes = accounts(spark, sf_dir).withColumn("batch_id", F.lit(0))
    return adhoc.table_counts({
        "credit_accounts": merge.merge_changes(changes),
        "bureau_score_events": scores(spark, sf_dir),
    })


@check(f"""{BOTH}, missing AS (SELECT DISTINCT consumer_id FROM fx_account_changes a
  WHERE NOT EXISTS (SELECT 1 FROM fx_scores s WHERE s.consumer_id = a.consumer_id))
SELECT (SELECT COALESCE(MAX(score_event_id), 100000) FROM fx_scores) + row_number() OVER
  (ORDER BY substr(md5(CAST(consumer_id AS VARCHAR)), 1, 3), consumer_id) AS score_event_id,
  consumer_id, CAST({BACKFILL_SCORE} AS INT) AS score_value, 'v3.0' AS score_version,
  'periodic_refresh' AS score_trigger, TIMESTAMP '{fx.AS_OF}' AS score_ts FROM missing""")
def score_gaps(spark, sf_dir):
    return reconcile.backfill_scores(*feeds(spark, sf_dir), BACKFILL_SCORE, as_of=fx.AS_OF)


SLOTS_SQL = ", ".join(f"round(f{i}, 9) AS f{i}" for i in range(9))


@check(f"{FEATURES} SELECT account_id, consumer_id, label, {SLOTS_SQL} FROM f")
def credit_features(spark, sf_dir):
    slots = [F.round(F.col("features")[i], 9).alias(f"f{i}") for i in range(9)]
    return features(spark, sf_dir).select("account_id", "consumer_id", "label", *slots)


@check(f"""{FEATURES} SELECT COUNT(*) AS n_rows, COUNT(DISTINCT label) AS n_classes,
CAST(CASE WHEN COUNT(*) < 20 THEN 'too few rows' WHEN COUNT(DISTINCT label) < 2
  THEN 'one class only' END AS VARCHAR) AS skip_reason FROM f""")
def train_gate(spark, sf_dir):
    return credit.train_gate(features(spark, sf_dir))


@check(f"""{SCORED} SELECT account_id, consumer_id, actual_delinquent,
round(probability_delinquent, 9) AS probability_delinquent, risk_tier FROM scored""")
def score_accounts(spark, sf_dir):
    return rounded(scored(spark, sf_dir))


@check(f"""{SCORED} SELECT risk_tier, COUNT(*) AS accounts,
round(AVG(probability_delinquent), 3) AS avg_probability FROM scored GROUP BY 1""")
def risk_tiers(spark, sf_dir):
    return kpi.tier_summary(scored(spark, sf_dir))


@check(f"""{SCORED} SELECT scored.account_id, scored.consumer_id, actual_delinquent,
round(probability_delinquent, 9) AS probability_delinquent, risk_tier, a.product,
CAST(a.outstanding_amount AS DOUBLE) AS outstanding_amount, a.dpd_bucket, a.status
FROM scored JOIN a ON a.account_id = scored.account_id
ORDER BY scored.probability_delinquent DESC, scored.account_id LIMIT 20""")
def top_risk(spark, sf_dir):
    return rounded(credit.top_risk_of(scored(spark, sf_dir), state(spark, sf_dir)))


def credit_run(spark: SparkSession, sf_dir: str) -> credit.CreditRun:
    path = work_dir(spark, "credit")
    return credit.run_credit(spark, *feeds(spark, sf_dir), path, AS_OF)


@check()
def credit_model(spark, sf_dir):
    """Fitted coefficients by slot."""
    model = credit_run(spark, sf_dir).model
    return model.select(F.posexplode("coef").alias("slot", "coef"))


@check("SELECT CAST(i AS INT) AS slot, CAST(0 AS DOUBLE) AS gradient FROM range(9) r(i)")
def model_score_equations(spark, sf_dir):
    """At the maximum of the likelihood the residuals are orthogonal to every feature."""
    run = credit_run(spark, sf_dir)
    rows = run.features.crossJoin(F.broadcast(run.model.select("coef")))
    chance = vectors.sigmoid(vectors.dot(F.col("coef"), F.col("features")))
    rows = rows.select(F.posexplode("features").alias("slot", "x"), (F.col("label") - chance).alias("rest"))
    sums = rows.groupBy("slot").agg(
        F.sum(F.col("rest") * F.col("x")).alias("sum"), F.sum(F.abs("x")).alias("size")
    )
    share = F.round(F.abs(F.col("sum") / F.greatest(F.col("size"), F.lit(1.0))), 5)
    return sums.select("slot", share.alias("gradient"))


@check()
def model_report(spark, sf_dir):
    return credit_run(spark, sf_dir).model


@check()
def credit_tiers_trained(spark, sf_dir):
    """The whole credit run: latest state, features, training, scores, tiers."""
    return credit_run(spark, sf_dir).summary


