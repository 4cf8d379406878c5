"""Column expressions: no DataFrame, no action, all evaluated in the JVM."""
