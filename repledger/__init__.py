"""Sales-commission analytics on Spark: conform, match, split, merge and report."""
