"""Operators for large text corpora: filtering, deduplication, decontamination and packing.

Nothing outside this folder imports it. Every operator takes and returns
DataFrames; ``queries.py`` has one query per operator over whole tables.
"""
