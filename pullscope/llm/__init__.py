"""Operators of a training-data pipeline: deduplication, classifiers, mixing, token files.

Nothing else in the library imports this subpackage. Each module holds one operator with its
own general interface; ``queries`` wraps them as registered queries and ``oracle`` holds their
DuckDB SQL where SQL can express the result.
"""
