"""Plans: fixture adapters over the driver tables and the registered query catalog."""
