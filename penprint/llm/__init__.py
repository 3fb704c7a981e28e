"""Operators for preparing training corpora: extraction, filtering, deduplication, scoring, mixing and output."""
