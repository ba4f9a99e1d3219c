"""Operators for large training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator over the whole ``documents`` or
``embeddings`` table. Nothing outside this subpackage imports it.
"""
