"""Customer analytics for multi-tenant retail data, written as Spark DataFrame transformations."""
