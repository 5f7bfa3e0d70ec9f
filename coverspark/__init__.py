"""Spark-native vegetation-cover analytics: DataFrame operators, declared lazily and left to Catalyst."""
