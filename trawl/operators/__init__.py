"""operators subpackage."""
