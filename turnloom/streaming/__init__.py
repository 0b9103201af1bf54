"""Running the row-local operators on streams."""
