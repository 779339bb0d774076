"""Composed plans: declared checks, materialisation and the full build."""
