"""Column builders: string helpers and chat templates."""
