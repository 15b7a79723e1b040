"""Service-request analytics on Spark: sources, cleaning, quality checks,
star schema and reports, all as DataFrame plans."""

__version__ = "0.1.0"
