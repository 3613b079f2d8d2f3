"""Whole plans: the pipeline, and the registered queries over the driver tables."""
