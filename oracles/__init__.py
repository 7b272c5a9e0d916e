"""SQL that other engines run on the base tables to check the Spark results."""
