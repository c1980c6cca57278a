"""Structured Streaming forms of the batch trend operators."""

from revlens.streaming.trends import monthly_trend_stream, start_monthly_trend  # noqa: F401
