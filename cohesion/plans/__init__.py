"""Entity and study jobs built from specs."""
