"""Operators for preparing language-model training data, and their queries.

Nothing outside this subpackage, ``tests/llm`` and ``corpus_pipeline.py``
imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
