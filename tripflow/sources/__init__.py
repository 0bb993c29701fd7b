"""Sources (table scans, raw feeds, monthly landing files), sinks and the catalog."""
