"""Transforms on whole DataFrames: keys, joins, reports, merges, contracts."""
