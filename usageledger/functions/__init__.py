"""Column expressions shared by the plans; nothing here runs Python per row."""
