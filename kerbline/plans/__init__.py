"""Layer plans (bronze, silver, gold), reports and the incremental month run."""
