"""Stoptide: transit-punctuality analytics expressed as Spark DataFrames."""
