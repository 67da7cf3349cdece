"""Event scans, attribute lookups and campaign sinks."""
