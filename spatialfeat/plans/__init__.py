"""Drivers that compose operators, and the catalogue of queries over the stand-in tables."""
