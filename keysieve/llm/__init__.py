"""Operators for preparing training text at scale.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. The ten
operators are in one module each; ``queries.py`` registers one query per
operator, with its DuckDB SQL where SQL can express it.
"""
