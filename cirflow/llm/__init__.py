"""Operators of a training-data pipeline: archives, scans, mixing, models,
near-duplicates, quality, tokens and language. Nothing outside this folder
imports it."""
