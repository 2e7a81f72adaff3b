"""Inputs: schedule tables and the synthetic fixtures derived from the driver tables."""
