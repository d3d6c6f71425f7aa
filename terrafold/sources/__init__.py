"""Readers and writers: rasters, GeoJSON, metadata, catalogs and feature tables."""
