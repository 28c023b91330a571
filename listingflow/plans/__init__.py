"""Composed jobs: the silver and gold steps, star queries and the batch runner."""
