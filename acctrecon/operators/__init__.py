"""DataFrame -> DataFrame operators, one per pipeline stage family."""
