"""Operators of a training-data pipeline (dedup, packing, search, PII, licences, mixing, quality, HTML).

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and ``__spark_entry__`` adds them when it can be imported.
"""
