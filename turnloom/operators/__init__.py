"""Table operators: ``DataFrame -> DataFrame`` functions with explicit key columns."""
