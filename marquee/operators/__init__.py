"""operators of the catalogue library."""
