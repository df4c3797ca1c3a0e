"""Table writers: append-per-batch tables, versioned full-refresh tables,
compaction and landing-file export."""
