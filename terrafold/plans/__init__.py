"""Whole jobs, each a single lazy plan over all scenes."""
