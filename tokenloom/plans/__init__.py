"""Size checks and the shared folder that written intermediate tables go to."""
