"""Operators for preparing large training corpora, each a ``DataFrame -> DataFrame`` job.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
