"""Reusable DataFrame operators (rank, mode, attribution, sequences, encodings)."""
