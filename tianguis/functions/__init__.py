"""Column expressions. Everything here stays inside the JVM."""
