"""Sources: driver tables, fixture views and the connectors (JSON list, HTML tables,
archives, staged tree, progress log)."""
