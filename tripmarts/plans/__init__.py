"""Analytical questions, and the stages that run everything against a lake."""
