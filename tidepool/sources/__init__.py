"""Scans and sinks: text tables, file inventories, reports, provenance."""
