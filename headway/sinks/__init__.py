"""Writers: CSV, GeoJSON layers, sets of tables."""
