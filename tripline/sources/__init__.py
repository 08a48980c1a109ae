"""Batch and streaming readers."""
