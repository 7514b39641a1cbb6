"""Fleet-delivery analytics written as plain Spark DataFrame functions."""
