"""DataFrame -> DataFrame operators. All lazy; none runs an action."""
