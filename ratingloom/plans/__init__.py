"""Jobs composed from operators, and the registered queries with their SQL twins."""
