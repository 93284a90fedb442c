"""Reading and writing staged records and warehouse tables."""
