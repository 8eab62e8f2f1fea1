"""Domain-neutral DataFrame operators; keys, values and order columns are parameters."""
