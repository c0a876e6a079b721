"""Incremental loads: manifests, slice and range reloads, watermarks, file streams."""
