"""functions subpackage."""
