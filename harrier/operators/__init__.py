"""Relational operators on images, tiles and detections."""
