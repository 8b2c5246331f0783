"""Reading the source query and the present state of the target."""
