"""sources subpackage."""
