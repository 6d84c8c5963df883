"""Relational operators: cleaning, enrichment, sessions, point-in-time history."""
