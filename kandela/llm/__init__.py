"""Operators of a training-data pipeline (dedup, search, filters, packing, mixing, sharding).

Nothing outside this folder imports it, except ``corpus_pipeline.py`` and the guarded
registration in ``__spark_entry__.py``."""
