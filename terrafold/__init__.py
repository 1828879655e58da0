"""terrafold: a PySpark-native lakehouse analytics library."""
