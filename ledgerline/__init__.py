"""Batch analytics on Spark: customer features, model diagnostics, multi-label
data preparation, vector retrieval and graph reports."""
