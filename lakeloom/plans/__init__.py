"""Plans: the medallion load, the profiling report and the registered query catalogue."""
