"""DataFrame -> DataFrame operators: validation, facts, windows, reports, quality."""
