"""Operators of a large-scale training-data pipeline. Nothing outside this
subpackage (but ``corpus_pipeline.py`` and the entry's guarded import) uses it."""
