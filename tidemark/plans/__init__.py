"""Analytic outputs and pipelines as lazy plans, and the mode registry."""
