"""Feeds: contracts, scans, projections and page parsers."""
