"""Decision queries on the three models, the stored warehouse and the catalogue."""
