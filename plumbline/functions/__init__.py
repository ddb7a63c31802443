"""Part of plumbline."""
