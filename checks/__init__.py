"""Registered queries: the lake's jobs run over the given order tables."""
