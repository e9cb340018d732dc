"""Date ranges and column expressions shared by the reports."""
