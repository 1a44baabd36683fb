"""Column expressions; nothing here reads data or runs a job."""
