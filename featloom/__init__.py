"""Numeric feature tables on Spark: clean, scale, cluster, score, publish."""
