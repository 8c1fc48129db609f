"""Distributed operators: prep, split, rank, profile, moments, fits, scoring, evaluation, explanation."""
