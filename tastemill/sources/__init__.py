"""Reading the input tables and writing recommendation output."""
