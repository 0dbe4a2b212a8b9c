"""DataFrame → DataFrame operators (no actions inside, except where noted)."""
