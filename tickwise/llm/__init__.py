"""Training-data operators: one module per operator, each with its own general interface.

``registered`` holds the thin queries of the driver contract; nothing outside this package imports it
except the guarded block in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
