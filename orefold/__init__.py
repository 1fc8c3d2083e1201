"""Market and disclosure analytics as Spark DataFrame functions."""
