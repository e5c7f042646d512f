"""Operators for building language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers the ``opN_<name>`` entries and their SQL.
"""
