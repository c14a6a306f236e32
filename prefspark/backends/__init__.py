"""Model backends: black boxes that turn text columns into scores and texts."""
