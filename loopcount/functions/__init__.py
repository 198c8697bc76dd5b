"""Column expressions only: no actions, no joins."""
