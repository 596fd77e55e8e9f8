"""waymark: place analytics and text-corpus operators as plain Spark jobs."""
