"""docket: a PySpark-native engine for public meeting records."""
