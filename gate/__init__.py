"""Registered queries and their SQL counterparts, on the TPC-H-like test tables."""
