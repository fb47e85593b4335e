"""The driver's queries and the SQL that must give the same rows."""
