"""Column expressions: no function here starts a job or looks at data."""
