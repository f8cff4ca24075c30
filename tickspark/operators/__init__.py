"""tickspark operators."""
