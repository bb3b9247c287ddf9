"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
