"""Column-level expressions; nothing here starts a job."""
