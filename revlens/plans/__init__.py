"""End-to-end jobs and the mapping from the driver's test tables."""
