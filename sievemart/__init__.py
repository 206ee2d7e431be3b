"""Spark-native cleaning, rollups and modelling for one wide, messy fact table."""
