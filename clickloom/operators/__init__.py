"""DataFrame operators: rows, joins, sets, aggregates, ordered data, series, encoding, models."""
