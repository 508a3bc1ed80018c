"""Reusable operators: contracts, cleaning, keys, joins, checks, profiles, time series, ranking."""
