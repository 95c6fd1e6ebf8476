"""Readers for CSV, JSON, text and in-memory rows."""
