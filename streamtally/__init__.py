"""Stream and table analytics as plain DataFrame functions for Spark."""

__version__ = "0.1.0"
