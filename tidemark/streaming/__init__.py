"""Structured Streaming forms of the monitoring job."""
