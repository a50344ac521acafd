"""Check on Spark that two tables agree, and load the tables to check."""
