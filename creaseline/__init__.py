"""Ball-by-ball analytics on Spark: conformed tables, scorecards, standings, quality checks and live streams."""
