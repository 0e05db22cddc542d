"""Column → Column scalar functions (built-in expressions unless noted)."""
