"""Fixed formats: record layouts and the request dictionary."""
