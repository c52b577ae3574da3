"""Clinical and subsurface record formats as tables."""
