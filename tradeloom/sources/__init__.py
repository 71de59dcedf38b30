"""Reading and writing: files, tables, the calendar, and views over the sample tables."""
