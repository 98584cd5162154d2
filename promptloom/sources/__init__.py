"""Readers and writers of prompt/response data sets."""
