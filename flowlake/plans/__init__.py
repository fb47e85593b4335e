"""Whole jobs: credit scoring, bulk load, ad hoc SQL."""
