"""Column expressions shared by the operators: rounding, guards, time, text."""
