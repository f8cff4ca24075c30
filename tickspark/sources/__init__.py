"""tickspark sources."""
