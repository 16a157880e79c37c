"""Plan-shaping helpers: size-checked broadcast and skew-safe ordering."""
