"""Column -> Column expressions. All of them run inside generated JVM code."""
