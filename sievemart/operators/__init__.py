"""Transforms from frame to frame, for use with ``DataFrame.transform``."""
