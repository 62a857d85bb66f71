"""tallyframe: table quality, exploration, scoring and testing as Spark DataFrame functions."""
