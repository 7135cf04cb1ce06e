"""DataFrame -> DataFrame operators (joins, aggregations, windows, folds)."""
