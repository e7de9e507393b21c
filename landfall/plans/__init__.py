"""Jobs: operators put together, reading and writing the stored tables."""
