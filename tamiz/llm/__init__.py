"""Training-data operators: one module per operator, plus the queries and SQL that apply them.

Nothing else in the library imports this subpackage.
"""
