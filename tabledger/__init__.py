"""tabledger: copy, track and validate large sets of tables with Spark."""
