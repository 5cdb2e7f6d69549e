"""Readers: landed files and JSON text become typed rows."""
