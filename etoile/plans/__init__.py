"""Plans: whole jobs and the registry of reports."""
