"""Whole jobs.  Each is a function of its input frames; sources and sinks are chosen
by the caller."""
