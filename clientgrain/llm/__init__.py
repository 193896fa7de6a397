"""Operators for preparing training data at corpus scale.

Each module holds one operator and its general interface; ``queries`` registers
the ``opN_<name>`` queries over the test tables.  Nothing outside this folder
and ``corpus_pipeline.py`` imports it.
"""
