"""Regulatory-filing tables on Spark: catalog, search, fetch plan, index, documents."""

__version__ = "0.1.0"
