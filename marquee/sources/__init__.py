"""sources of the catalogue library."""
