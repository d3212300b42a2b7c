"""tallyweave: a PySpark-native engine for payable documents and their master data."""

__version__ = "0.1.0"
