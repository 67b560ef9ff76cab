"""End-to-end flows, the named query registry and their oracle SQL."""
