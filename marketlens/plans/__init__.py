"""Plans: reports, catalogue and measurement jobs built from DataFrame ops."""
