"""Retail sales warehouse on Spark: two sales channels in, one star schema out."""
