"""Datasets in and out: versioned registry, file formats and the run log."""
