"""caseloom: weekly case-surveillance analytics as PySpark DataFrame code."""
