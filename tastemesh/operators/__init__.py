"""DataFrame → DataFrame operators; no session creation, no collect."""
