"""DataFrame operators: frame in, frame out, no actions unless documented."""
