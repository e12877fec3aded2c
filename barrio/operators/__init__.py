"""DataFrame -> DataFrame operators: normalize, nested, dedupe, aggregates,
unify, label, forecast, models, registry, quality, joins."""
