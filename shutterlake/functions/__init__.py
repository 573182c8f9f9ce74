"""Column expressions shared by the operators; all stay in the JVM."""
