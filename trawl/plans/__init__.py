"""plans subpackage."""
