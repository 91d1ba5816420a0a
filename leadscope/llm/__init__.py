"""Operators for building language-model training data.

Nothing else in the package imports this subpackage.  Each ``opNN_*`` module holds one operator with a
general interface; ``queries`` binds them to the driver's tables and ``oracles`` holds their SQL.
"""
