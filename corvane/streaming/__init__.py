"""Streaming.

There are no streaming operators: every source is a batch. The column functions in
``corvane.functions`` are row-local and can be applied to a streaming DataFrame as they are,
which ``tests/test_text.py`` checks.
"""
