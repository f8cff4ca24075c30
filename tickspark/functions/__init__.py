"""tickspark functions."""
