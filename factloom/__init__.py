"""Source-backed statistical facts as Spark DataFrame operators."""

__version__ = "0.1.0"
