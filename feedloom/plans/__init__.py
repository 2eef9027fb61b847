"""Job compositions (build, gate+label, profile) and the driver query registry."""
