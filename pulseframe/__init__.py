"""Spark-native analytics over semi-structured wellness payloads.

Sub-packages
------------
``functions``  column expressions: variant paths, keys, calendar parts
``sources``    envelopes, collector registry, payload recipes
``operators``  DataFrame-to-DataFrame operators
``plans``      staging models, marts, and the query catalogue
``streaming``  file-stream landing
"""

from pulseframe.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
