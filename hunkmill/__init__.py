"""hunkmill: a PySpark-native engine for building and analysing code-review datasets."""
