"""Operators on records: deduplication, validation, chunking, similarity, resolution, cascades."""
