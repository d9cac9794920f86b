"""Column functions. Everything here runs inside the JVM unless stated."""
