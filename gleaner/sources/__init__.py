"""Readers and writers: tables, feeds, dictionaries, robots files, item lines."""
