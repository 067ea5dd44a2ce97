"""PySpark-native feature engine for spatial-omics imaging tables."""
