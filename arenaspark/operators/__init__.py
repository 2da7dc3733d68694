"""DataFrame -> DataFrame operators, grouped by input shape."""
