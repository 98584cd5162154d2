"""DataFrame operators for preparing, running and evaluating language-model data jobs on Spark."""

__version__ = "0.1.0"
