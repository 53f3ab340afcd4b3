"""Writers: partitioned files, warehouse tables, message topics and CSV extracts."""
