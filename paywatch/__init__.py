"""Payment-fraud analytics on Spark: features, models, scoring, monitoring queries."""
