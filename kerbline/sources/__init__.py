"""Scans: monthly trip files, the zone CSV, stored tables and named views."""
