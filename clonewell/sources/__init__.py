"""Sources of clonewell."""
