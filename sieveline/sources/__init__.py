"""Document batches, table changes and versioned index folders."""
