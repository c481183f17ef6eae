"""Plans: operators bound to tables."""
