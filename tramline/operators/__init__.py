"""Relational and data-quality operators, all parametrised by column names."""
