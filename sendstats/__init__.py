"""Message-campaign analytics on nested session logs, as Spark DataFrames."""
