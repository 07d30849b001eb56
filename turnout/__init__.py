"""Windowed analytics over streams of event-RSVP messages, as plain PySpark DataFrame jobs."""
