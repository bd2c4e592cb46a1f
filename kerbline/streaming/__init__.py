"""Trips as a stream of delivered files."""
