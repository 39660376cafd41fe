"""Funnel, identity, text and ledger analytics as Spark jobs: functions from DataFrames to a DataFrame."""
