"""Molecular-QTL fine-mapping and its post-analysis on Spark DataFrames."""
