"""Operators of a training-data pipeline over documents.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
