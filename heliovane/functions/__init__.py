"""Column expressions. Each takes and returns ``Column``; none touches a session."""
