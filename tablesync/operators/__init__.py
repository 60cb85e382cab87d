"""Table operators: windows, projections, joins, aggregates, replacement."""
