"""Verification and analytics of document submissions on Spark DataFrames."""
