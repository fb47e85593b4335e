"""Flowlake: streaming ingestion, KPIs, latest state and credit scoring on PySpark."""
