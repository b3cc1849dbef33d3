"""Column expressions. Everything here runs in the JVM; there are no UDFs."""
