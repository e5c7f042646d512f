"""DataFrame -> DataFrame operators, grouped by workflow."""
