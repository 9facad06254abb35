"""Operators: pure DataFrame functions, one per model or analysis."""
