"""Canonical tables: alignment, contracts, reads and idempotent writes."""
