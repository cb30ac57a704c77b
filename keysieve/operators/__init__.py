"""Relational operators over DataFrames (features, breach join, profiles,
sampling, metrics, models)."""
