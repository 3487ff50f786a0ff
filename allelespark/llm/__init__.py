"""Operators of a training-data pipeline: dedup, filtering, mixing, counting and token output over documents."""
