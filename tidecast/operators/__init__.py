"""DataFrame operators: joins, metrics, series, holidays, folds, scores, forecasts, reports."""
