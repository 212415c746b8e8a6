"""Compositions: Spark ML preprocessing, estimator presets, training runs, and the registered queries with oracles."""
