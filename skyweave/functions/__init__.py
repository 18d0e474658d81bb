"""Column expressions shared by the parse jobs and the derivations."""
