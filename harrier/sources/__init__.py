"""Readers of images and of the label dimension."""
