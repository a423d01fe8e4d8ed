"""shelfwatch: product price-snapshot analytics as plain Spark DataFrame transforms."""
