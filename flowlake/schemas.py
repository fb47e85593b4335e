"""Fixed schemas of messages, external files and target tables."""

from __future__ import annotations

# One row per message, as the Kafka source gives it with the value cast to text.
TOPIC = """
    key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP
"""

ORDERS = """
    order_id STRING, timestamp TIMESTAMP_NTZ, customer_id STRING, customer_name STRING,
    customer_email STRING, product_id STRING, product_name STRING, category STRING,
    quantity INT, unit_price DECIMAL(10,2), total_price DECIMAL(10,2), payment_method STRING,
    country STRING, city STRING, revenue_bucket STRING, is_bulk_order BOOLEAN,
    processing_time TIMESTAMP_NTZ
"""

ORDERS_MIRROR = """
    order_id STRING, timestamp TIMESTAMP_NTZ, customer_id STRING, customer_name STRING,
    customer_email STRING, product_id STRING, product_name STRING, category STRING,
    quantity BIGINT, unit_price DOUBLE, total_price DOUBLE, payment_method STRING,
    country STRING, city STRING, revenue_bucket STRING, is_bulk_order BOOLEAN,
    processing_time TIMESTAMP_NTZ
"""

READINGS = """
    id STRING, timestamp TIMESTAMP_NTZ, sensor_id STRING, location STRING,
    temperature DECIMAL(5,2), humidity DECIMAL(5,2), pressure DECIMAL(6,2),
    battery_level DECIMAL(5,2), status STRING, alert_level INT, building STRING, floor INT,
    temperature_f DECIMAL(5,2), comfort_index STRING, battery_status STRING,
    processed_at TIMESTAMP_NTZ, data_quality STRING
"""

ACCOUNTS = """
    account_id BIGINT, consumer_id BIGINT, lender_id INT, product STRING,
    sanctioned_amount DECIMAL(18,6), outstanding_amount DECIMAL(18,6), dpd_bucket STRING,
    status STRING, opened_ts TIMESTAMP_NTZ, event_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ
"""

SCORES = """
    score_event_id BIGINT, consumer_id BIGINT, score_value INT, score_version STRING,
    score_trigger STRING, score_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ
"""

INQUIRIES = """
    inquiry_id BIGINT, consumer_id BIGINT, lender_id INT, purpose STRING, channel STRING,
    inquiry_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ
"""

# feed_id is the source offset, which repeats across partitions: it is no key on its own.
LANDING = """
    feed_id BIGINT, lender_id INT, source_topic STRING, source_partition INT,
    payload_type STRING, feed_channel STRING, event_ts TIMESTAMP_NTZ, ingested_ts TIMESTAMP_NTZ
"""

RISK_FEATURES = "account_id BIGINT, consumer_id BIGINT, label INT, features ARRAY<DOUBLE>"

RISK_SCORES = """
    account_id BIGINT, consumer_id BIGINT, actual_delinquent INT,
    probability_delinquent DOUBLE, risk_tier STRING
"""

PRICES = """
    symbol STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT
"""

NEWS = "symbol STRING, date STRING, headline STRING, sentiment STRING, close DOUBLE"
