"""Operators for preparing language-model training text.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.  Each module
holds one operator with a general interface; ``queries.py`` derives the
registered ``opN_<name>`` results from the operators' outputs.
"""
