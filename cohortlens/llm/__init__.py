"""Operators and pipeline stages for preparing language-model training data at scale.

One module per operator; ``queries.py`` registers them.  Nothing else in the library
imports this package.
"""
