"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing outside this folder imports it. Each operator has a module of its own; ``queries`` registers one query per
operator, and ``corpus_pipeline.py`` at the top of the repository chains five of them.
"""
