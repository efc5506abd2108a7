"""JSON and GeoJSON results, and files of them."""
