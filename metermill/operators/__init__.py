"""DataFrame operators: unnesting, union and column dropping."""
