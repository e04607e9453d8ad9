"""A Spark-native SQL engine that answers MySQL-dialect queries with DataFrames and Catalyst."""
