"""Operators of a training-data pipeline: thirteen stand-alone operators and their queries.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries when the folder is present.
"""
