"""DataFrame-to-DataFrame operators; none of them runs an action."""
