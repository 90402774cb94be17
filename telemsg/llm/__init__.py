"""Operators for large text corpora: cleaning, de-duplication, scoring, archives and mixing.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its queries when it is present).
"""
