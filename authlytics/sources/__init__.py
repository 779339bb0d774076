"""Readers for the raw tables."""
