"""Re-surveys that start when new snapshot files arrive."""
