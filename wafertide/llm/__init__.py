"""Operators for preparing language-model training corpora.

Every operator module has its own general interface; ``queries`` holds the thin ``opN_*`` queries over the
synthetic tables.  Nothing outside this subpackage imports it.
"""
