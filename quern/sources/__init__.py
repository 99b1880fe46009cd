"""Typed records from raw, already-fetched payloads."""
