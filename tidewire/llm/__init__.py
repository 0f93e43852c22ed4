"""Operators of a large-scale training-data pipeline.

Nothing outside this package imports it; the registered queries are in
``tidewire.llm.queries``.
"""
