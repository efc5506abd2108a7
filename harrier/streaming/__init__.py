"""Images that keep arriving in a folder."""
