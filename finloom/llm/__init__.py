"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` binds the
operators to the driver's tables and ``oracles`` holds the SQL that expresses
them.  Nothing outside this subpackage imports it.
"""
