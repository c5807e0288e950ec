"""Edit-stream analytics as plain DataFrame -> DataFrame functions for Spark."""
