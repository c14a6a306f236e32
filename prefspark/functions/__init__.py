"""Column expressions; none of them shuffles or leaves the JVM."""
