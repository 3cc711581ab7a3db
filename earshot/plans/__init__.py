"""The listening reports, each a function of tables (and a date) to a DataFrame."""
