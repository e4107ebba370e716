"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing outside this folder imports it; the registered queries are in
:mod:`issuelens.llm.queries`.
"""
