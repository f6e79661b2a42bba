"""Training-data operators: one module per operator, queries in ``catalog``.

Nothing else in the library imports this subpackage.
"""
