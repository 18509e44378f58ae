"""Household-survey welfare harmonisation as keyed Spark DataFrames."""
