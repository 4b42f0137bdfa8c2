"""Operators for large-scale training-data pipelines.

One module per operator, named after the task it does.  The registered queries and
their contract columns live in ``curata.llm.catalog``; nothing outside this folder
imports it except ``__spark_entry__.py`` (guarded) and ``corpus_pipeline.py``.
"""
