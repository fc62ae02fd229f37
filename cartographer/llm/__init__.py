"""Operators of a training-data pipeline over ``documents`` and ``pages``.

One module per operator, ``queries`` registers them; nothing outside this
subpackage imports it.
"""
