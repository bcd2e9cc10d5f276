"""Column expressions; nothing here reads data or starts a job."""
