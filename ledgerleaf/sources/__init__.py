"""Readers: files, sidecars, reference tables, reports, manifests and queue envelopes."""
