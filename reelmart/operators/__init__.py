"""DataFrame operators: windows, explode, joins, incremental merge, exact
median, set operations, data quality, profiling and history synthesis."""
