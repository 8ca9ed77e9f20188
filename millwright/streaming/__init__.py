"""Operators over unbounded sources."""
