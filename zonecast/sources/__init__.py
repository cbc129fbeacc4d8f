"""Readers, driver-table views and sinks."""
