"""Readers, writers and the adapters that shape the driver's tables as posts."""
