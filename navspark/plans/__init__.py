"""Composed plans: the skew-safe sequence-window plan and the end-to-end
pipeline."""
