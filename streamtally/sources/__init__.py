"""Sources: table adapters, files and optional connectors."""
