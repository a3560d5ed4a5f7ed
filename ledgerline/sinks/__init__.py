"""Sinks: the filing store, snapshots, the JSON company list, archives and run logs."""
