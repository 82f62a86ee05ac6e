"""granary: a PySpark-native engine that prepares and analyses text corpora."""
