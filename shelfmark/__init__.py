"""Retail sales on Spark: raw CSV -> bronze -> silver -> gold, DataFrame in and DataFrame out."""
