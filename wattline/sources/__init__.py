"""Sources: table scans, derived fixtures, the weather document."""
