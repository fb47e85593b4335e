"""DataFrame operators: parsing, latest state, merge, joins, KPIs, reconciliation."""
