"""Training-data operators: ten dataset-preparation jobs and their queries.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
