"""Reading and writing: files, raw landing, warehouse tables."""
