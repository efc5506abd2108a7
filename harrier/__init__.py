"""Oriented-box detections in imagery as Spark DataFrames: read, tile, detect, decode, suppress, merge, count, export."""
