"""Ordered-series functions, indicators and signal rules."""
