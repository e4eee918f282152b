"""Training-data operators: one module per operator, their queries and SQL in ``queries``.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
