"""panelcast."""
