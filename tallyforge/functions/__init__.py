"""Column expressions and the fixed values of the ready-made student presets."""
