"""The analyses on the test tables, each with an independent SQL statement of its result."""
