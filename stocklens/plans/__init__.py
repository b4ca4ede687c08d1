"""The reports: each reads the tables and returns one lazy DataFrame."""
