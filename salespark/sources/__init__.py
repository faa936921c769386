"""Sources: table scans, the derived sale-event fixture, dimensions, topics."""
