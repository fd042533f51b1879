"""Operators for preparing language-model training data.

Each module holds one operator with a general interface (real outputs: texts,
spans, ids); :mod:`ferrovia.llm.queries` derives the registered result tables
from them.  Nothing else in the library imports this subpackage.
"""
