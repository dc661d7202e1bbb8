"""reuselens: a PySpark-native engine for finding and measuring re-use of near-identical items."""
