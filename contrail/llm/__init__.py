"""Operators of a training-data pipeline (see queries.py for the registered queries).

Nothing outside this package imports it except the guarded block in
``__spark_entry__.py`` and the stages of ``corpus_pipeline.py``.
"""
