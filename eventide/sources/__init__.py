"""Reading from and writing to lake tables, files, databases and the catalog."""
