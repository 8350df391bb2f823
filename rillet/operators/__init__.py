"""DataFrame operators: aggregates, joins/set logic, ranking, statistics, windows."""
