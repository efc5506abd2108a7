"""Schemas of the tables that pass between operators."""

GEO = "struct<tie_x: double, tie_y: double, scale_x: double, scale_y: double, epsg: int>"
IMAGES = f"image_id bigint, path string, width int, height int, is_geotiff boolean, geo {GEO}, channels int, pixels binary, error string"
TILES = "image_id bigint, tile_idx int, sx int, sy int, sw int, sh int, scale double, pad_x double, pad_y double, sliced boolean"
RAW_OUTPUT = f"{TILES}, data array<float>"
DETECTIONS = "image_id bigint, seq bigint, class_id int, class_name string, confidence double, cx double, cy double, width double, height double, angle double"
