"""Sources and sinks: source catalogs, staged tables, snapshots, published tables."""
