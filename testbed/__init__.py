"""Rail-shaped data out of the test tables, and the registered queries on it."""
