"""medlark: health-data analytics as plain DataFrame -> DataFrame functions on Spark."""
