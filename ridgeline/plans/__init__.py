"""Task tables, end-to-end pipelines and the registered query catalogue."""
