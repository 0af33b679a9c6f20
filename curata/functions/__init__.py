"""Curata subpackage."""
