"""Operators of the training-data pipeline, one module each, and their queries.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when the subpackage is there.
"""
