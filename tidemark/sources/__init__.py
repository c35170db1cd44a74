"""Readers and writers of files, notes, logs and ledgers."""
