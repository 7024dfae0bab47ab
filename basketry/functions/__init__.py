"""Column -> Column helpers; all of them stay inside the JVM."""
