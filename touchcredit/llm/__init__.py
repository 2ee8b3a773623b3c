"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
