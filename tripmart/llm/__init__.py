"""Operators for large training-data pipelines over a ``documents`` table.

One module per operator; each keeps a general interface, and
``queries.py`` registers the thin ``opN_<name>`` queries. Nothing outside
this folder (but ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py``) uses it.
"""
