"""streaming subpackage."""
