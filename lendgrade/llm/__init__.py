"""Operators of a training-data pipeline: filtering, deduplication, encoding,
packing and archiving of text collections.

Nothing outside this subpackage imports it. Each module holds one operator
with its own interface; ``registry`` binds the operators to the tables as the
``opN_<name>`` queries.
"""
