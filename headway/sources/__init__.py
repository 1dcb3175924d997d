"""Readers: delimited text, archives, spatial layers, census tables, warehouses."""
