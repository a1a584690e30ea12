"""Readers and writers: raster tiles, GeoJSON, OSM JSON, tables, CSV, run log."""
