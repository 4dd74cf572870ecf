"""Filters, metrics, merge, landing, publishing, watermark state and load log."""
