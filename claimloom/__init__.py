"""Claim-evidence analytics on PySpark: batch operators over reviews, citations, sources and verdicts."""

__version__ = "0.1.0"
