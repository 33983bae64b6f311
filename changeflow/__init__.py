"""changeflow: change-data-capture for stock tables, expressed as Spark jobs."""

__version__ = "0.1.0"
