"""Operators of a large-scale training-data pipeline.

Nothing outside this sub-package imports it; its queries are in ``queries``.
"""
