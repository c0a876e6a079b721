"""Transformations between the layers; each takes and returns DataFrames."""
