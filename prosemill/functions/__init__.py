"""Column expressions: no function here starts a job or moves a row."""
