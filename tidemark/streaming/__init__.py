"""Available-now ingest and snapshot cursors."""
