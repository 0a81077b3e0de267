"""Operators for training-data pipelines (texts, pages, conversations).

Nothing else in the library imports this subpackage; its queries are added by
``__spark_entry__.py`` when it can be imported.
"""
