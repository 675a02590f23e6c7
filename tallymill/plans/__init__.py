"""Named queries and the batch build, composed from the operators."""
