"""Pure DataFrame -> DataFrame operators; no action runs inside them."""
