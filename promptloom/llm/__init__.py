"""Operators of a training-data pipeline, each by one named method; ``queries`` registers them."""
