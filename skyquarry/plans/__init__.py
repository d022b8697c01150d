"""Views over input tables, the map pipeline and its configuration."""
