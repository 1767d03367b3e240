"""Readers and writers for the text formats of a sequencing workflow."""
