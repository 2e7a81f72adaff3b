"""Operators for training-data pipelines: one module per operator, Spark frames in and out."""
