"""Load requests, their rules, cursor state and the load itself."""
