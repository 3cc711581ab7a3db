"""earshot: listening analytics written as plain Spark DataFrame programs."""
