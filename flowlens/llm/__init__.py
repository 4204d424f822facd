"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries`` derives the registered
digest queries from them.
"""
