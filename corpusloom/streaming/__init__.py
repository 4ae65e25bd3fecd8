"""New files as they arrive: running n-gram counts and index batches."""
