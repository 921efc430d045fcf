"""The reading kinds, their translation and the unified feed."""
