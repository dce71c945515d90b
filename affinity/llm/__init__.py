"""Operators for preparing training data, each a function of DataFrames.

Nothing else in the library imports this subpackage; the registered queries
are in ``affinity.llm.queries`` and the composed run in ``corpus_pipeline``.
"""
