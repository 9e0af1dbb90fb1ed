"""Layered shop warehouse on Spark: change logs and behaviour logs in, dimension tables and facts out."""
