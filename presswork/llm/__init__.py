"""Training-data operators (ten operators and their queries).

Nothing outside this subpackage, ``corpus_pipeline.py`` and ``tests/llm``
imports it; ``__spark_entry__.py`` adds its queries when it can be imported.
"""
