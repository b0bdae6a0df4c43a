"""Reading, ingesting and laying out incident tables."""
