"""DataFrame -> DataFrame operators (reshape, statements, estimates, growth,
ratios, align, assemble, quality, datasets, metrics, models)."""
