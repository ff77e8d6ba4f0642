"""Operators: staging, metrics, marts, reports, checks, validator, synthetic
events and incremental loads, each a composition of DataFrame operations."""
