"""Column to Column functions; all of them are evaluated row by row in the JVM."""
