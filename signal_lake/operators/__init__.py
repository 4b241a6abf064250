"""DataFrame operators: dedup, ranking, joins that survive hot keys, table updates."""
