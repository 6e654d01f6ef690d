"""Operators of a training-data pipeline: curation, matching and encoding of text.

Nothing outside this subpackage imports it. Each module holds one operator
with a general interface; ``queries`` binds them to the given tables.
"""
