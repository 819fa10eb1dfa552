"""Inputs, registered queries, their SQL counterparts, and the streaming jobs."""
