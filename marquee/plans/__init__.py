"""plans of the catalogue library."""
