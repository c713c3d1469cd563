"""Sources and sinks: the feed (GeoJSON), the driver's tables, written tables."""
