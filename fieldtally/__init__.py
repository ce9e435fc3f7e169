"""Player-season analytics as plain DataFrame functions on Spark."""
