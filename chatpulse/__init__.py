"""Chat activity and toxicity metrics over history and over live streams."""
