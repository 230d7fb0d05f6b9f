"""Operators of a large-scale training-data pipeline.

Nothing outside this package imports it.  Each module holds one operator with
a general interface; ``queries`` derives the registered result columns."""
