"""Readers: order event streams and ad-hoc SQL over tables."""
