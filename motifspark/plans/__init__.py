"""Composite flows (F1-F8) and run planning."""
