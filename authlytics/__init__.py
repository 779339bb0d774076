"""Login and identity event analytics as lazy Spark DataFrame functions."""
