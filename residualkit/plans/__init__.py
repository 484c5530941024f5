"""The composed jobs: features, training, scoring; and the queries over the test tables."""
