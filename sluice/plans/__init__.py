"""Plans of the verticals, their settings, and the queries of the catalogue."""
