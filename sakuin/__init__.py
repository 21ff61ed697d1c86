"""Sakuin: register analytics and corpus preparation on Spark DataFrames."""
