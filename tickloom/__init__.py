"""Windowed market features on Spark: DataFrame -> DataFrame operators."""
