"""Incremental (micro-batch) evaluation of the row-level quality checks."""

from veritab.streaming.quality import read_stream, totals, watch
