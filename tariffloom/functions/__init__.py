"""Column functions of the engine: each takes and gives columns and stays inside code generation."""
