"""Operators of a training-data pipeline, each by its own method, on Spark.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""
