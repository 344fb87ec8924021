"""Column-level functions (no DataFrame, no session)."""
