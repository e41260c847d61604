"""weftmatch: a PySpark-native record-linkage and data-quality engine."""

__version__ = "0.1.0"
