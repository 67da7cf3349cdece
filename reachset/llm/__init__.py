"""Operators of a training-data pipeline: dedup, mixing, packing, sharding, classification.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
