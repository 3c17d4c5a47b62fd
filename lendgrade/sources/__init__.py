"""Schemas, readers and the raw-application derivation."""
