"""Streams over the incoming folder and the queue."""
