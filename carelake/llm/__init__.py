"""Operators of a training-data pipeline (sharding, dedup, scoring, mixing,
tokenizing, search).  Nothing outside this subpackage imports it."""
