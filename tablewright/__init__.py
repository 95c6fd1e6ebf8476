"""DataFrame operators, pipelines and file/catalog access for Spark."""

__version__ = "0.1.0"
