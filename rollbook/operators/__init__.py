"""Upserts, codes, locations, organisations, reconciliation, control."""
