"""Plans: the staging view, the fact table, and the jobs of one day."""
