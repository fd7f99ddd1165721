"""DataFrame operators, grouped by job: projection, validation, joins, profile,
split, prep, models, metrics, drift, quality, fairness, rollup, registry."""
