"""Operators for large training corpora: filtering, deduplication, decontamination, scans, packing."""
