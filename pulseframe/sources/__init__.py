"""Envelopes, the collector registry, and payload recipes."""
