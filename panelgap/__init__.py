"""panelgap: Spark-native panel cleaning, gap metrics, ranking and profile modelling."""

__version__ = "0.1.0"
