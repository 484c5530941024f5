"""residualkit: residual modelling over repeated transactions, written for Spark.

``sources``    reading and writing tables, run configuration
``functions``  column expressions and column-name helpers
``operators``  joins, grouped statistics, encodings, folds, history, models
``plans``      the composed jobs: features, training, scoring
"""

__version__ = "0.1.0"
