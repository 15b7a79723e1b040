"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing outside this package imports it; the registry adds its queries only
when it can be imported.
"""
