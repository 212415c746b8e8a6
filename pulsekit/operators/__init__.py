"""DataFrame -> DataFrame operators: profiling, cleaning, features, sampling, evaluation, distribution tests,
Shapley values, and the ordered-statistics primitive they share."""
