"""Operators for building training corpora: packing, archives, similarity joins, scoring, search, filters, mixing."""
