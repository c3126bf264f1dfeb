"""Writers of tabs."""
