"""halocline: a PySpark-native analytics engine for gridded coastal-current hindcasts."""
