"""Column expressions: no job, no shuffle, no Python on the executors."""
