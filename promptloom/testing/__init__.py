"""Deterministic stand-ins for models. They prove the plumbing, not the quality of any model."""
