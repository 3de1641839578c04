"""The raw tables, the warehouse models and the tables of the report, as functions of DataFrames."""
