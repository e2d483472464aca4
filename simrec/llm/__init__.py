"""Operators of a training-data pipeline: mixing, deduplication, filtering,
decontamination, formatting and counting of text documents.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
