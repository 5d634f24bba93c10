"""Readers: a path or connection in, a lazy DataFrame out."""
