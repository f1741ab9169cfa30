"""Plans that build the warehouse's layers from stored tables."""
