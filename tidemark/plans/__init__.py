"""Plan tables: what to reprocess, what to archive or delete."""
