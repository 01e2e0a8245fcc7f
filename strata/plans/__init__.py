"""Plans: star-schema builders, the metric layer, gated layered builds,
business questions, report datasets and the registered query catalogue."""
