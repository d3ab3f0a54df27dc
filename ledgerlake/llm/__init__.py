"""Training-data operators: one module per operator, ``queries.py`` registers them.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
