"""Relational building blocks used by several reports."""
