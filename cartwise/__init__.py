"""Purchase-intent features, data sets and votes from an action log, on Spark."""
