"""Typed scans, vendor feeds, sinks."""
