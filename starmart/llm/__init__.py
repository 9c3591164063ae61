"""Operators for large-scale training-data preparation.

Nothing outside this folder (and the repository's ``corpus_pipeline.py``)
imports it; ``starmart.llm.queries`` registers one query per operator.
"""
