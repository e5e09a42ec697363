"""Incremental landing of record archives."""
