"""Plans: bronze, silver and gold tables, reports, data quality, validation."""
