"""Operators for building training corpora: deduplication, scans, labels, mixing and binary output."""
