"""Set-based operators from DataFrame to DataFrame."""
