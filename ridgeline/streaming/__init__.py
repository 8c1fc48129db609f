"""Structured Streaming form of the scoring step: fitted models applied to rows
arriving as files (the reference itself has no streaming)."""
