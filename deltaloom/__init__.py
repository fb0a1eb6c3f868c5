"""Change-data pipelines on Spark: YAML definitions compiled to lazy DataFrames, with batch and streaming runs."""

__version__ = "0.1.0"
