"""Operators for preparing language-model training data (optional subpackage).

Nothing else in the library imports this package; ``__spark_entry__.py``
registers its queries only when it is present.
"""
