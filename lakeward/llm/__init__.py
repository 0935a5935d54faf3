"""Operators for preparing training corpora, with their queries.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when the subpackage can be imported.
"""
