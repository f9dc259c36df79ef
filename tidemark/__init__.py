"""tidemark: versioned full snapshots, current state, history and marts on Spark."""
