"""weft: a PySpark-native engine for building and auditing text corpora."""
