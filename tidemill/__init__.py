"""Spark-first analytics for bars, labels, scores and decisions."""
