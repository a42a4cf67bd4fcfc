"""Operators for large training-data pipelines: search, tokenisation,
quality, secrets, personal data, mixing, sharding and de-duplication."""
