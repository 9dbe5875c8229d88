"""Column functions: zone-free time arithmetic, storage types, text parsing."""
