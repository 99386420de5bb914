"""Zonal analytics on Spark: gridded measurements reduced over polygons, declared as DataFrame plans."""
