"""Inputs (raw events, fixture timeline, labels), the typed timeline and sinks."""
