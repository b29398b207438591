"""Functions of clonewell."""
