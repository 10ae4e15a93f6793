"""Operators of a training-data pipeline (see README, "llm"): one module per
operator, ``queries`` with the registered queries, ``oracle`` with their SQL.

Nothing outside this folder (but ``corpus_pipeline.py``) imports it.
"""
