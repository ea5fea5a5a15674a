"""Structured Streaming forms of the row-wise operators."""

from baobab.streaming.cleaning import clean_customer_stream, clean_drops, run_clean_customer_job

__all__ = ["clean_customer_stream", "clean_drops", "run_clean_customer_job"]
