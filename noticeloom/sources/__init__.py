"""Readers and writers: fetched pages, snapshots, profiles, the source registry."""
