"""Operators put together: evaluation, the end-to-end job, the query registry."""
