"""spanlab — Spark-native toolkit for price-interval modelling on listing tables.

Sub-packages: ``sources`` (readers, writers, fixture views), ``functions``
(Column builders, exact ranks, exact quantiles), ``operators`` (DataFrame →
DataFrame steps, fitted models, tuning, text and neighbour operators,
pipeline stages), ``plans`` (the registered query catalogue with its oracle
SQL), ``llm`` (training-data operators).
"""

__version__ = "0.1.0"
