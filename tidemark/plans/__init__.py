"""Workflows that chain operators: training, scoring, explanation and release records."""
