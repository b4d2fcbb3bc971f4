"""Table specs, extracts, and the versioned zones jobs write to."""
