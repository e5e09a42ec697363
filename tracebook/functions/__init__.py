"""Column functions: keys, scoring, record rules and display forms (all JVM-side)."""
