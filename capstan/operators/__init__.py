"""DataFrame -> DataFrame operators built from the column rules."""
