"""File readers, the versioned table store and the sinks built on it."""
