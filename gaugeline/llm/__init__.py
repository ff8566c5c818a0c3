"""Operators of a training-data pipeline over tables of texts, vectors and urls."""
