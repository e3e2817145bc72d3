"""Column expressions and aggregate expressions; every one stays inside the JVM."""
