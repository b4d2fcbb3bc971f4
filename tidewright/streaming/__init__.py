"""Micro-batch entry to the keyed merge."""
