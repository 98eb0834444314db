"""Sources and sinks: CSV, the lineitem-derived transaction feed, table storage."""
