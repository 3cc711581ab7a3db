"""Reading tables, files, databases and event feeds."""
