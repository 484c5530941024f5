"""DataFrame operators: joins, statistics, encodings, folds, history, models."""
