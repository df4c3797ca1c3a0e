"""Scans: landing files, tier tables, the trade adapter over the driver tables,
and the synthetic trade generator."""
