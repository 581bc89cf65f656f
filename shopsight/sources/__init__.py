"""Reading, cataloguing, materializing and publishing tables."""
