"""Column-level building blocks. Everything here is a JVM-side expression."""
